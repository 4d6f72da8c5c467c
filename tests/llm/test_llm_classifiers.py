import random

import numpy as np
import pyarrow as pa
import pytest
from llm_data import MESSY, docs_of, empty, messy, prose
from pyspark.sql import functions as F

from tillroll.llm import language_id, quality_fm, toxicity
from tillroll.llm.words import remainder


def labelled(n=160):
    rng, rows, labels = random.Random(6), [], []
    for i in range(n):
        toxic, good = i % 4 == 0, i % 3 != 0
        sentences = [prose(1000 * i + k, 9).capitalize() for k in range(6)]
        if toxic:
            sentences[rng.randrange(6)] += " you vile oaf"
        text = ". ".join(sentences) + "."
        i += 100
        rows.append((i, text if good else text.upper().replace(" ", " $$ "), "en", "s", 1))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def world(spark):
    rows, labels = labelled()
    return docs_of(spark, rows + MESSY), spark.createDataFrame([*labels, (10_000, 1, 1), (4, None, None)], "doc_id bigint, quality int, toxic int"), labels


@pytest.mark.parametrize(("module", "column"), [(quality_fm, "quality"), (toxicity, "toxic")])
def test_held_out_documents_are_told_apart(spark, world, module, column):
    docs, labels, truth = world
    model = module.train(docs, labels, eligible=remainder("id", 4) != 2)
    scored = module.score(docs, model).withColumn("held", remainder("doc_id", 4) == 2)
    rows = scored.join(labels.where("quality is not null"), "doc_id").where("held").collect()
    right = [(r.score >= 0.3) == (r[column] == 1) for r in rows if r.doc_id >= 100]
    assert len(right) > 25 and np.mean(right) > 0.9
    assert scored.count() == docs.count() and scored.where("score < 0 or score > 1 or score is null").isEmpty()


def test_offending_sentences_are_located(spark, world):
    docs, labels, _ = world
    model = toxicity.train(docs, labels)
    for r in toxicity.score(docs, model).join(docs.select("doc_id", "text"), "doc_id").where("score > 0.5").collect():
        raw = r.text.encode()
        assert r.sentences and all(b"oaf" in raw[s.start : s.end].lower() and s.score >= 0.3 for s in r.sentences)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.where(F.lower("text").contains("oaf")).isEmpty()
    assert kept.count() == docs.where("text is null or lower(text) not like '%oaf%'").count()


@pytest.mark.parametrize(("module", "column"), [(quality_fm, "quality"), (toxicity, "toxic")])
@pytest.mark.parametrize("labels", [[], [(4, 1, 1), (6, 1, 1)], [(6, 0, 0)]])
def test_one_sided_labels_and_empty_tables(spark, module, column, labels):
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = module.train(messy(spark), table)
    scores = {round(r.score, 9) for r in module.score(messy(spark), model).collect()}
    assert len(scores) == 1 and all(0 <= s <= 1 for s in scores)
    assert module.score(empty(spark), model).count() == 0
    assert module.train(empty(spark), table) is not None


def test_pairwise_term_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    x = quality_fm.Features(np.array([0, 0, 0, 1, 1]), np.array([0, 1, 2, 1, 3]), rng.random(5), 2)
    w, v = rng.random(4), rng.random((4, 3))
    got, _ = quality_fm._margin(x, 0.5, w[x.feature], v[x.feature])
    for t in (0, 1):
        at = np.flatnonzero(x.text == t)
        pairs = sum(v[x.feature[i]] @ v[x.feature[j]] * x.value[i] * x.value[j] for i in at for j in at if i < j)
        assert abs(got[t] - (0.5 + sum(w[x.feature[i]] * x.value[i] for i in at) + pairs)) < 1e-9


def test_languages(spark):
    rows = [(i, prose(i, 60, stem), lang, "s", 1) for i, (stem, lang) in enumerate([("xyzw", "xx"), ("mnpq", "mm"), ("kléö", None)] * 30)]
    docs = docs_of(spark, rows + MESSY)
    model = language_id.train(docs.where("doc_id % 4 <> 2"))
    found = {r.doc_id: r for r in language_id.identify(docs, model).collect() if r.doc_id is not None and r.doc_id > 12}
    assert all(found[i].lang_pred == lang for i, _, lang, *_ in rows if lang and i > 12)
    assert all(0 <= r.score <= 1 for r in found.values())
    odd = {(r.doc_id, r.lang_pred) for r in language_id.identify(docs, model).where("doc_id in (1, 2, 3, 10)").collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (10, "und")} <= odd
    nobody = language_id.train(empty(spark))
    assert {r.lang_pred for r in language_id.identify(messy(spark), nobody).collect()} == {"und"}
    assert language_id.identify(empty(spark), model).count() == 0


def plain_bundle(space, text):
    """A text's vector by definition: letter by letter, n-gram by n-gram, in Python numbers."""
    word = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    points = [0] + [ord(c) if c != " " else 0 for c in " ".join(word.split())] + [0]
    out = np.zeros(space.dimensions)
    if len(points) == 2:
        return out

    def vector(point, place):
        bits = np.unpackbits(space.letters(np.array([point])).view(np.uint8))
        return np.roll(1 - 2 * bits.astype(int), 64 * place)

    for i in range(len(points) - space.ngram + 1):
        out += np.prod([vector(p, place) for place, p in enumerate(points[i : i + space.ngram])], axis=0)
    return out


def test_bundles_equal_sums_of_bound_vectors():
    for ngram in (2, 3):
        space = language_id.Hypervectors(128, ngram)
        texts = ["Abc déf", "ab", "", None, "漢字 \U00020000x", "12 --", "a", " ünd  so. weiter "] + [prose(i, 30) for i in range(150)]
        got = space.bundles([space.grams(t) for t in texts], np.arange(len(texts)), len(texts))
        assert np.array_equal(got, np.stack([plain_bundle(space, t) for t in texts]))
    with pytest.raises(ValueError):
        language_id.Hypervectors(100)


def test_no_two_letters_share_a_vector():
    space = language_id.Hypervectors()
    letters = np.array([ord(c) for c in "abcdefghijklmnopqrstuvwxyzабвгдежзийклмнопрстуфхцчшщъыьэюяあいうえおかきくけこ漢字語"])
    signs = 1 - 2.0 * np.unpackbits(space.letters(letters).view(np.uint8), axis=1)
    cosines = signs @ signs.T / space.dimensions
    assert np.abs(cosines - np.eye(len(letters))).max() < 0.1


def test_identify_equals_brute_force(spark):
    stems = {"xx": "xyzw", "mm": "mnpq", "ru": "шщжэ", "kk": "かきくけ"}
    rows = [(100 + i, prose(i, 3 + i % 20, stem), lang, "s", 1) for i, (lang, stem) in enumerate([*stems.items()] * 8)]
    docs = docs_of(spark, rows + MESSY)
    model = language_id.train(docs.where("doc_id % 4 <> 2"), dimensions=256)
    space = language_id.Hypervectors(256)
    data = docs.collect()
    sums = {}
    for r in data:
        if r.doc_id is not None and r.doc_id % 4 != 2 and r.lang is not None:
            sums[r.lang] = sums.get(r.lang, 0) + plain_bundle(space, r.text)
    sums = {k: v for k, v in sums.items() if v.any()}
    expected = []
    for r in data:
        mine = plain_bundle(space, r.text)
        cosine = {k: mine @ v / max(np.linalg.norm(mine) * np.linalg.norm(v), 1e-9) for k, v in sums.items()}
        best = max(sorted(cosine), key=lambda k: cosine[k])
        expected.append((r.doc_id, best if mine.any() else "und", max(0.0, cosine[best]) if mine.any() else 0.0))
    got = language_id.identify(docs, model).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    for a, b in zip(sorted(map(tuple, got), key=order), sorted(expected, key=order), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-5
    with pytest.raises(ValueError, match="more than 3 languages"):
        language_id.train(docs, dimensions=64, most_languages=3)


def test_close_languages_of_one_script(spark):
    # The same letters in both, in another order; held-out texts of five words.
    rng = random.Random(3)
    words = {"r1": ["молоко", "дорога", "город", "вода", "берег", "слово", "голова", "ворона"], "r2": ["млеко", "драга", "град", "вадо", "брег", "волос", "глава", "врана"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(5 if i % 4 == 2 else 30)), lang, "s", 1) for i in range(200) for lang in ("r1", "r2")]
    docs = docs_of(spark, rows)
    model = language_id.train(docs.where("doc_id % 4 <> 2"))
    held = docs.where("doc_id % 4 = 2").withColumn("doc_id", F.concat_ws(":", "lang", "doc_id"))
    found = language_id.identify(held, model).collect()
    assert len(found) == 100 and np.mean([r.doc_id.split(":")[0] == r.lang_pred for r in found]) > 0.95


def test_sentences_know_their_bytes():
    s = toxicity.sentences_of(pa.array(["Ünder é. Two words!\n\n?", None, "last"]))
    assert s.text.tolist() == [0, 0, 2]
    assert [("Ünder é. Two words!\n\n?".encode() if t == 0 else b"last")[a:b].decode() for t, a, b in zip(s.text, s.start, s.end)] == ["Ünder é", "Two words", "last"]


@pytest.mark.parametrize("column", ["quality", "toxic"])
def test_long_texts_are_learned_whole(spark, column):
    # What the label rests on lies beyond the first 40 KB, and the heads are equal.
    head = "plain talk of the day. " * 1800
    texts = [(i, head + (f"you vile oaf {i}. " if i % 2 else f"a fine friend {i}. ") + prose(i, 9) + ".", "en", "s", 1) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)], "doc_id bigint, quality int, toxic int")
    docs = docs_of(spark, texts)
    module = quality_fm if column == "quality" else toxicity
    scored = {r.doc_id: r.score for r in module.score(docs, module.train(docs, labels)).collect()}
    assert all((scored[i] >= 0.3) == bool(i % 2) for i in range(60))
