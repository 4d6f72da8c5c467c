import random
import re

import pytest
from llm_data import MESSY, docs_of, empty, messy

from tillroll.llm import decontamination as D


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    w, hit, found = words(text), set(), set()
    for item, value in items:
        v = words(value)
        n = min(window, len(v))
        runs = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in runs:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(w), hit, sorted(found)


def benchmark_of(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, n_words int")


@pytest.mark.parametrize("shard_words", [20, 10_000])
@pytest.mark.parametrize("letters", ["ab", "abcde"])
def test_spans_and_items_against_brute_force(spark, letters, shard_words):
    rng = random.Random(len(letters) + shard_words)
    text = lambda n: rng.choice(["", "-"]) + "".join(rng.choice(letters) + rng.choice([" ", ". ", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 4, 5, 9, 15]))) for i in range(12)] + [(50, None), (51, ".."), (3, text(6))]
    rows = [(i, text(rng.choice([0, 1, 3, 30, 60])), None, None, 1) for i in range(60)] + MESSY
    got = D.contamination(docs_of(spark, rows), benchmark_of(spark, items), window=4, shard_words=shard_words).collect()
    found = sorted(((r.doc_id, r.n_words, [k for s in r.spans for k in range(s.first, s.after)], list(r["items"])) for r in got), key=str)
    expected = []
    for r in rows:
        n, hit, names = brute(r[1], items, 4)
        expected.append((r[0], n, sorted(hit), names))
    assert found == sorted(expected, key=str)


def test_cut_texts_hold_no_window_and_clean_ones_are_untouched(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    clean = " ".join(f"Plain{i}," for i in range(40))
    rows = [(1, f"{clean} {item.upper()}! {clean}", "en", "s", 1), (2, clean, "en", "s", 7), (3, item, "en", "s", 1), (4, None, "en", "s", None)]
    docs, items = docs_of(spark, rows), benchmark_of(spark, [(1, item)])
    out = D.decontaminate(docs, items, n_chars="n_chars")
    assert out.columns == docs.columns
    kept = {r.doc_id: r for r in out.collect()}
    assert set(kept) == {1, 2, 4} and kept[2].text == clean and kept[2].n_chars == 7
    assert kept[1].text == f"{clean}  ! {clean}" and kept[1].n_chars == len(kept[1].text)
    assert D.decontaminate(messy(spark), items).count() == len(MESSY)


def cut_by_hand(text, items, window, most):
    """The words that stay, or None for a document that goes."""
    n, hit, _ = brute(text, items, window)
    return None if len(hit) > most * n else [w for i, w in enumerate(words(text)) if i not in hit]


def test_cuts_do_not_depend_on_the_shards(spark):
    run = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(run[:22])), (2, " ".join(run[14:30])), (3, " ".join(run[30:]))]  # 1 and 2 overlap, 3 begins where 2 ends
    clean = " ".join(f"plain{i}" for i in range(60))
    rows = [(1, f"{clean} {' '.join(run[:25])} {clean}", "en", "s", 1), (2, " ".join([*run[:12], *run[30:], "and", "more"]), "en", "s", 1)]
    rows += [(3, f"{' '.join(run)} {clean}", "en", "s", 1), (4, clean, "en", "s", 9)]
    docs, bench = docs_of(spark, rows), benchmark_of(spark, items)
    results = [sorted((tuple(r) for r in D.decontaminate(docs, bench, n_chars="n_chars", shard_words=n).collect()), key=str) for n in (10, 25, 10_000)]
    assert results[0] == results[1] == results[2]
    left = {r[0]: r for r in results[0]}
    for doc, text, *_ in rows:
        stays = cut_by_hand(text, items, D.WINDOW, D.MOST_COVERED)
        assert (words(left[doc][1]) if doc in left else None) == stays
    assert 2 not in left and all(left[d][4] == len(left[d][1]) for d in (1, 3))


def test_empty_tables(spark):
    none = benchmark_of(spark, [])
    assert D.contamination(empty(spark), benchmark_of(spark, [(1, "a b")])).count() == 0
    assert all(not r.spans and not r["items"] for r in D.contamination(messy(spark), none).collect())
    assert D.decontaminate(messy(spark), none).count() == len(MESSY)
