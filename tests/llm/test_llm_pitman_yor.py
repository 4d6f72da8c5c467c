import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import MESSY, docs_of, empty, messy, prose
from pyspark.sql import functions as F

from tillroll.llm import pitman_yor as P
from tillroll.llm.words import remainder
from tillroll.operators.staging import Staging


def rows():
    rng = random.Random(2)
    vocabulary = [prose(i, 1) for i in range(300)]
    return [(i, " ".join(vocabulary[int(300 * rng.random() ** 3)] for _ in range(rng.randint(0, 60))), None, None, 1) for i in range(150)] + MESSY


@pytest.mark.parametrize("buckets", [2, 7])
def test_counts_and_base_against_brute_force(spark, buckets):
    data = rows()
    got = P.score(docs_of(spark, data), remainder("doc_id", 7) == 2, buckets=buckets).collect()
    tokens = [(r[0], [*(r[1] or "").encode().lower().split(), None]) for r in data]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    c = Counter(w for d, ws in tokens if not held(d) for w in ws)
    n, v = sum(c.values()), len(c)
    expected = [(d, held(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws in tokens]
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got], key=str) == sorted(expected, key=str)
    held_out = [r for r in got if r.held_out and r.n_tokens > 5]
    assert np.mean([r.score - r.base_score for r in held_out]) > 0


def test_probabilities_of_all_words_sum_to_one_in_every_context(spark):
    docs = docs_of(spark, rows())
    model, counts = P.train(docs, Staging(spark), 3)
    total = P.unknown_probability(model)
    for r in counts.collect():
        dishes = P._read_counts([bytes(r["counts"])])
        p = dishes.predictive(model, r["bucket"])
        assert (p > 0).all()
        total = total + p.sum(0)
    assert np.allclose(total, 1, atol=1e-9)


def test_hot_words_are_scored_alike(spark, monkeypatch):
    docs = docs_of(spark, rows())
    some = sorted((r.doc_id or 0, round(r.score, 6)) for r in P.score(docs, F.lit(False), buckets=3).collect())
    monkeypatch.setattr(P, "HOT_SHARE", 2.0)
    assert sorted((r.doc_id or 0, round(r.score, 6)) for r in P.score(docs, F.lit(False), buckets=3).collect()) == some


def test_seating_follows_the_exact_distribution():
    rng, d, start, rate, n = np.random.default_rng(1), 0.6, 2.0, 0.3, 5
    weight = [math.exp(P.stirling(d)[n, t]) * math.prod(start + d * j for j in range(t)) * rate**t for t in range(1, n + 1)]
    tables = P.seat(np.full(40_000, n), np.full(40_000, rate), np.full(40_000, start), d, P.stirling(d), rng)
    assert np.allclose(np.bincount(tables, minlength=n + 1)[1:] / 40_000, np.array(weight) / sum(weight), atol=0.01)
    many = P.seat(np.array([1, 1000, 5000]), np.full(3, 0.01), np.full(3, 5.0), d, P.stirling(d), rng)
    assert many[0] == 1 and 1 <= many[1] <= 1000 and many[2] <= 5000


def test_empty_table_and_nothing_to_train_on(spark):
    assert P.score(empty(spark), F.lit(False), buckets=2).count() == 0
    untrained = P.score(messy(spark), F.lit(True), buckets=2).collect()
    assert len(untrained) == len(MESSY) and all(r.score == 0 and r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in untrained)


def test_a_task_that_runs_again_names_its_blocks_alike():
    import pyarrow as pa

    hot = {"word": np.zeros(0, np.uint64), "n": np.zeros(0), "p": np.zeros((0, P.CONTEXTS))}
    model = P.Model.__new__(P.Model)
    model.__dict__["hot"] = hot
    batch = pa.record_batch([pa.array(range(50)), pa.array([prose(i, 40) for i in range(50)]), pa.array([i % 7 == 2 for i in range(50)])], ["doc_id", "text", "held_out"])
    once, again = (list(P._ask(iter([batch, batch]), model, 5)) for _ in range(2))
    assert [b.to_pydict() for b in once] == [b.to_pydict() for b in again] and len({r for b in once for r in b.column("block").to_pylist()}) == len(once)
