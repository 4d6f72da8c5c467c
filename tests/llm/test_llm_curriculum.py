import random

import pytest
from llm_data import MESSY, docs_of, empty, messy
from pyspark.sql import functions as F

from tillroll.llm import curriculum as C


def goals(sizes):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    wanted, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = wanted - sum(2 * sizes[s] for s in capped)
        total = sum(weights[s] for s in names if s not in capped) or 1
        out = {s: 2.0 * sizes[s] if s in capped else weights[s] * rest / total for s in names}
        more = {s for s in names if s not in capped and out[s] > 2 * sizes[s]}
        if not more:
            return out
        capped |= more


@pytest.mark.parametrize("bucket_rows", [3, 10_000])
def test_targets_and_what_is_taken(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(C, "BUCKET_ROWS", bucket_rows)
    rng = random.Random(8)
    rows = [(i, "w " * rng.choice([0, 1, 5, 40]), None, rng.choice([None, "hot", "hot", "b", "é", f"s{i % 4}"]), 1) for i in range(300)]
    rows += rows[:20] + MESSY
    docs = docs_of(spark, rows)
    arranged, names = C.arrange(docs, C.n_words(F.col("text")))
    got = arranged.select("doc_id", "source", *[F.col(c).alias(k) for k, c in names.items()]).collect()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    expected, taken = goals(sizes), dict.fromkeys(sizes, 0)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) < 1e-6
        assert r.taken in (0, r["size"], 2 * r["size"]) and list(r.positions) == sorted(r.positions) and all(0 <= p <= 1 for p in r.positions)
        taken[r.source] += r.taken
    largest = max(len((r[1] or "").split()) for r in rows)
    assert all(abs(taken[s] - expected[s]) <= largest for s in sizes)
    again = C.arrange(docs.repartition(7), C.n_words(F.col("text")))[0].select("doc_id", names["taken"]).collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in arranged.select("doc_id", names["taken"]).collect())


def test_positions_invert_the_integral_of_the_weights(spark):
    row = spark.range(1).select(*[C.demand_position(F.lit(x), F.lit(a)).alias(f"p{x}{a}") for x in (0.0, 0.3, 1.0) for a in (-0.5, 0.0, 0.5, 1.0)]).first()
    for (x, a), t in zip([(x, a) for x in (0.0, 0.3, 1.0) for a in (-0.5, 0.0, 0.5, 1.0)], row):
        assert abs((1 + a) * t - a * t * t - x) < 1e-9


def test_the_mix_is_sorted_and_has_a_row_per_copy(spark):
    docs = messy(spark)
    arranged, names = C.arrange(docs, C.n_words(F.col("text")))
    copies = arranged.select(F.sum(F.size(names["positions"]))).first()[0]
    mixed = C.mixed(docs)
    added = [c for c in mixed.columns if c not in docs.columns]
    assert mixed.count() == copies and len(added) == 1
    places = [r[0] for r in mixed.select(added[0]).collect()]
    assert places == sorted(places)
    assert "Python" not in mixed._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark):
    assert C.arrange(empty(spark), C.n_words(F.col("text")))[0].count() == 0
    assert C.mixed(empty(spark)).count() == 0


def test_the_arrangement_is_range_sorted_by_first_position(spark):
    docs = messy(spark)
    arranged, names = C.arrange(docs, C.n_words(F.col("text")))
    ordered = C.in_training_order(arranged, names["positions"], "doc_id")
    assert "rangepartitioning" in ordered._jdf.queryExecution().executedPlan().toString()
    firsts = [r[0][0] if r[0] else 2.0 for r in ordered.select(names["positions"]).collect()]
    assert firsts == sorted(firsts) and len(firsts) == docs.count()
