import itertools
import random

import pytest
from llm_data import MESSY, docs_of, empty, messy, prose

from tillroll.llm import jaccard_join


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*[words[k:] for k in range(5)])) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            parent[root(i)] = root(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[root(i)] = min(doc, ids.get(root(i), doc))
    return sorted(((d, len(s), ids.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def near_copies():
    rng, rows = random.Random(3), []
    shared = prose(77, 60)
    for base in range(12):
        words = prose(base, rng.choice([3, 8, 20, 60, 150, 400])).split()
        for _ in range(rng.randint(1, 14)):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice("uvwxyz") * 3
            rows.append((rng.randrange(10_000), " ".join(copy) + (" " + shared if rng.random() < 0.3 else "")))
    return rows + rows[:5] + [(i + 20_000, "The same LINE of six words") for i in range(40)]


@pytest.mark.parametrize("slices", [None, (4, 400)])
def test_components_against_brute_force(spark, monkeypatch, slices):
    if slices:
        monkeypatch.setattr(jaccard_join, "SLICE_CLASSES", slices[0])
        monkeypatch.setattr(jaccard_join, "SLICE_SHINGLES", slices[1])
    rows = near_copies()
    got = jaccard_join.similar(docs_of(spark, [(d, t, None, None, None) for d, t in rows])).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_messy_rows(spark):
    got = jaccard_join.similar(messy(spark)).select("doc_id", "n_shingles", "component_id").collect()
    rows = [(r[0], r[1]) for r in MESSY]
    expected = [(d, n, d if n == 0 else c) for d, n, c in brute(rows)]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert jaccard_join.similar(empty(spark)).count() == 0


def test_rows_without_an_id_link_others(spark):
    base = prose(5, 80).split()
    change = lambda words, places: [f"x{i}" if i in places else w for i, w in enumerate(words)]
    middle = change(base, {10})
    rows = [(1, " ".join(base)), (None, " ".join(middle)), (2, " ".join(change(middle, {40}))), (None, prose(6, 50)), (7, prose(7, 50)), (None, prose(7, 50))]
    want = brute(rows)
    assert [c for d, _, c in want if d in (1, 2)] == [1, 1]
    got = jaccard_join.similar(docs_of(spark, [(d, t, None, None, None) for d, t in rows])).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_one_row_of_each_group_stays(spark):
    kept = jaccard_join.keep_first(messy(spark))
    assert kept.columns == messy(spark).columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None) == [1, 2, 3, 4, 6, 8, 8, 9, 10]
    assert kept.count() == 10
    assert jaccard_join.keep_first(empty(spark)).count() == 0
