"""The restaurants of op10's model are those of whole words."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import docs_of, prose
from pyspark.sql import functions as F

from tillroll.llm import pitman_yor as P
from tillroll.llm.words import U64
from tillroll.operators.staging import Staging


def test_words_that_end_alike_predict_differently(spark):
    texts = ["knew ba"] * 40 + ["view ca"] * 40
    rows = [(i, t, None, None, 1) for i, t in enumerate([*texts, "knew ca", "view ba"])]
    got = {r.doc_id: r.score for r in P.score(docs_of(spark, rows), F.col("doc_id") >= len(texts), buckets=3).collect()}
    assert got[0] > got[80] + 0.5 and got[40] > got[81] + 0.5


def corpus():
    rng = np.random.default_rng(5)
    vocabulary = [prose(i, 1) for i in range(40)]
    return [" ".join(vocabulary[int(40 * x)] for x in rng.random(rng.integers(0, 30)) ** 3) for _ in range(120)]


def brute_force(learned, kept):
    """(tokens and tables of pairs, tables of contexts by what scoring reads, by word: the parent's customers and tables)."""
    pairs, tables, told, parent = {}, defaultdict(dict), Counter(), {}
    rows = defaultdict(lambda: defaultdict(list))
    for r in learned.known.collect():
        rows[r.bucket][r.kind].append(bytes(r.data))
    for kinds in rows.values():
        word, context, n = P._read_pairs(kinds[P._PAIRS])
        seats = P._read_seats(kinds[P._SEATS])
        drawn = np.ones(len(n), int)
        if len(n):
            drawn[n > 1] = seats.tables[kept]
        for w, u, k, t in zip(word.tolist(), context.tolist(), n.tolist(), drawn.tolist()):
            assert (w, u) not in pairs
            pairs[w, u], tables[w][u] = k, t
        words = list(dict.fromkeys(word.tolist()))
        for w, hot, p in zip(words, seats.hot_at, seats.parents[kept] if words else []):
            parent[w] = p if hot < 0 else learned.model.totals[kept + 1].hot_tables[hot]
        for blob in kinds[P._CONTEXTS]:
            high, low, d = P._unpack(blob)
            told.update(dict(zip(P._join(high, low).tolist(), d.tolist())))
        for blob in kinds[P._ADDED]:
            high, low, *more = P._unpack(blob)
            told.update(dict(zip(P._join(high, low).tolist(), more[kept - P.BURN_IN].tolist())))
    return pairs, tables, told, parent


@pytest.mark.parametrize("share, buckets", [(0.03, 3), (2.0, 5)])
def test_scores_follow_from_counts_and_tables(spark, share, buckets):
    texts = corpus()
    docs = docs_of(spark, [(i, t, None, None, 1) for i, t in enumerate(texts)])
    hot, _ = P._frequent(docs, "text", share)
    assert (len(hot) > 0) == (share < 1)
    learned = P.learn(docs, Staging(spark), hot, buckets)
    model, theta, d, d0 = learned.model, P.CONCENTRATION, learned.model.discount, learned.model.parent_discount
    hashes = {w: int(h) for t in texts if t for w, h in zip(t.lower().split(), P.tokens_of(__import__("pyarrow").array([t])).word)}
    end, context = int(P._END), lambda w: int(P.context_of(np.array([w], U64))[0])
    expected_pairs = Counter((w, context(u)) for t in texts for s in [[end, *[hashes[x] for x in t.lower().split()], end]] for u, w in zip(s, s[1:]))
    words = sorted({w for w, _ in expected_pairs})
    probability = defaultdict(float)
    for kept in P._KEPT:
        pairs, tables, told, parent = brute_force(learned, kept)
        assert pairs == expected_pairs
        of_context, tokens = Counter(), Counter()
        for (w, u), n in pairs.items():
            of_context[u] += tables[w][u]
            tokens[u] += n
            assert 1 <= tables[w][u] <= n
        assert of_context == told
        guests = {w: sum(tables[w].values()) for w in words}
        customers, n_tables = sum(guests.values()), sum(parent.values())
        assert (customers, n_tables) == (model.totals[kept + 1].parent_customers, model.totals[kept + 1].parent_tables)
        new = (theta + d0 * n_tables) / (theta + customers)
        for u in tokens:
            back = (theta + d * of_context[u]) / (theta + tokens[u])
            sums = 0
            for w in words:
                p0 = (guests[w] - d0 * parent[w]) / (theta + customers) + new * model.known()
                p = max(pairs.get((w, u), 0) - d * tables[w].get(u, 0), 0) / (theta + tokens[u]) + back * p0
                probability[w, u] += p / len(P._KEPT)
                sums += p
            assert sums + back * new * model.unknown() == pytest.approx(1)
    by_hand = [sum(np.log10(probability[w, context(u)]) for s in [[end, *[hashes[x] for x in t.lower().split()], end]] for u, w in zip(s, s[1:])) for t in texts]
    P_share, P.HOT_SHARE = P.HOT_SHARE, share
    try:
        got = {r.doc_id: r.score for r in P.score(docs, F.lit(False), buckets=buckets).collect()}
    finally:
        P.HOT_SHARE = P_share
    assert [got[i] for i in range(len(texts))] == pytest.approx(by_hand)
