import hashlib
import random

import pytest
from llm_data import docs_of, empty, messy
from pyspark.sql import functions as F

from tillroll.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def steps(levels, i):
    """Of each level: the run that the node stands in, and its place there."""
    out = []
    for level in levels[:-1]:
        out.append((level[i // 2 * 2 : i // 2 * 2 + 2], i % 2))
        i //= 2
    return out


def brute(rows, change):
    """rows: (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    ordered = {lang: sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for lang in langs}
    trees = {lang: tree_of([leaf_of(r) for r in ordered[lang]]) for lang in langs}
    forest = tree_of([trees[lang][-1][0] for lang in langs]) if langs else []
    out = []
    for t, lang in enumerate(langs):
        for i, row in enumerate(ordered[lang]):
            runs = steps(trees[lang], i) + steps(forest, t)
            folded = leaf_of(change(row))
            for run, place in runs:
                folded = h(*[folded if j == place else x for j, x in enumerate(run)])
            siblings = [x for run, place in runs for j, x in enumerate(run) if j != place]
            root = forest[-1][0]
            out.append((row[0], leaf_of(row), trees[lang][-1][0], root, h(*siblings), folded, folded == root))
    return sorted(out, key=repr)


def changed(row):
    odd = row[0] is not None and row[0] % 3 == 0 and row[3] is not None
    return (*row[:3], row[3] + 1, row[4]) if odd else row


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def compare(docs, bits):
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    presented = {"n_chars": F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    got = merkle.manifest(docs, presented=presented, bits=bits)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    assert got == brute(rows, changed)
    return got


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_brute_force_in_superblocks_of_any_size(spark, bits):
    rng = random.Random(2)
    rows = [(i, f"text {i}", rng.choice(["en"] * 6 + ["de", "é", "z"]), "s", i) for i in rng.sample(range(1000), 83)]
    rows += [(5000, "alone", "fr", None, 3), (2**60 + 1, "large", "en", None, None), (None, "no id", "en", "s", 6)]
    got = compare(docs_of(spark, rows), bits)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_messy_documents_repeated_rows_and_an_empty_table(spark):
    compare(messy(spark).unionByName(messy(spark)), 2)
    assert merkle.manifest(empty(spark)).count() == 0
    got = compare(docs_of(spark, [(1, "one", "en", None, 3)]), 3)
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h()


def test_proofs_lead_to_the_root_and_nothing_else_does(spark):
    docs = docs_of(spark, [(i, f"t{i}", "en" if i % 5 else "de", "s", i) for i in range(30)])
    for r in merkle.manifest(docs, bits=2, with_proof=True).collect():
        assert r.verified and merkle.fold(r.leaf, r.proof) == r.root and merkle.proof_digest(r.proof) == r.proof_sha256
        assert merkle.fold(h("other"), r.proof) != r.root


def test_other_columns_and_keys(spark):
    docs = docs_of(spark, [(i, f"t{i}", "en", f"s{i % 4}", i) for i in range(20)])
    got = merkle.manifest(docs, columns=["text"], tree="source", order="text")
    assert got.columns[0] == "text" and len({r.subroot for r in got.collect()}) == 4
