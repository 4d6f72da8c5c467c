import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import LONG, docs_of, empty, messy

from tillroll.llm import phrases


def brute(rows, longest=3, least=10, percent=50, limit=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= percent * a for b in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:limit], 1)]
    return sorted(out)


def rows_of(seed, n):
    rng = random.Random(seed)
    words = ["New", "york", "times", "é", "the", "of", "x1", "--", "ÀB", "\U0001F600", "it's"]
    gaps = [" "] * 12 + ["  ", "\t", ", ", ".\n", "!", "\r\n", "\x0b"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    rows = [(t, rng.choice(["en", "en", "de", None, "und"])) for t in texts]
    return rows + [(texts[0], "en")] * 40 + [(None, "en"), ("", "de"), (" .,\n", None)]


def collected(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("width", [64, 13])
def test_brute_force_also_when_fingerprints_collide(spark, width):
    rows = rows_of(3, 120)
    docs = docs_of(spark, [(i, t, lang, None, None) for i, (t, lang) in enumerate(rows)])
    got = collected(phrases.collocations(docs, width=width))
    assert got == brute(rows) and len(got) > 50


@pytest.mark.parametrize(("longest", "least", "percent", "limit"), [(4, 3, 30, 2000), (2, 5, 50, 7)])
def test_other_settings(spark, longest, least, percent, limit):
    rows = rows_of(5, 60)
    docs = docs_of(spark, [(i, t, lang, None, None) for i, (t, lang) in enumerate(rows)])
    assert collected(phrases.collocations(docs, longest, least, percent, limit)) == brute(rows, longest, least, percent, limit)


def test_ranks_are_the_same_when_buckets_hand_on_their_rows(spark, monkeypatch):
    rows = rows_of(5, 60)
    docs = docs_of(spark, [(i, t, lang, None, None) for i, (t, lang) in enumerate(rows)])
    monkeypatch.setattr(phrases, "RANK_ROWS", 40)
    monkeypatch.setattr(phrases, "LOT", 100)
    assert collected(phrases.collocations(docs, limit=20)) == brute(rows, limit=20)


def test_messy_and_empty_tables_and_a_long_text(spark):
    assert collected(phrases.collocations(empty(spark))) == []
    docs = messy(spark)
    rows = [(r.text, r.lang) for r in docs.collect()]
    got = collected(phrases.collocations(docs, least=4))
    assert got == brute(rows, least=4) and any(r[0] == "en" for r in got)
    assert len(LONG.split()) == 6000


def test_spans_do_not_depend_on_the_window(monkeypatch):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 5000).astype(np.uint64)
    first = np.arange(4000)
    whole = phrases._Polynomial(phrases._BASES[0]).over(values, first, first + 3)
    monkeypatch.setattr(phrases, "_SPAN", 10)
    assert (phrases._Polynomial(phrases._BASES[0]).over(values, first, first + 3) == whole).all()


def test_a_filter_never_says_no_to_what_it_has(spark):
    keys = spark.range(-3000, 3000, 2).selectExpr("id * 1234567891011 AS k")
    found = phrases._filter_of(keys, "k", 3000)
    own = np.arange(-3000, 3000, 2, dtype=np.int64) * 1234567891011
    assert found.has(own.view(np.uint64)).all() and found.has((own + 1).view(np.uint64)).mean() < 0.05
    assert not phrases._filter_of(keys.limit(0), "k", 0).has(own.view(np.uint64)).any()
