import math
import random
import re

from llm_data import MESSY, docs_of, empty, messy, prose
from pyspark.sql import functions as F

from tillroll.llm import quality_rules as Q


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed


def repetitive():
    rng = random.Random(2)
    rows = []
    for n in (0, 1, 2, 3, 4, 10, 60, 300):
        for letters in ("a", "ab", "abcdefg"):
            rows.append("".join(rng.choice(letters) + rng.choice([" ", "\n", " | ", "\t"]) for _ in range(n)))
    return rows + ["\n".join(["same line here", "é# other"] * 30), " ".join(f"w{i % 90}" for i in range(400))]


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_against_brute_force(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(repetitive())] + MESSY
    docs = docs_of(spark, rows)
    got = Q.judge(docs, Q.references(docs), out="verdict").select("doc_id", *[f"verdict.{n}" for n in NAMES]).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(r[0], *counts(r[1])) for r in rows], key=str)


def test_distance_of_distributions(spark):
    rows = [([0.5, 0.5], [0.5, 0.5]), ([1.0, 0.0], [0.0, 1.0]), ([0.9, 0.1], [0.4, 0.6])]

    def js(p, q):
        part = lambda a, b: a * math.log2(2 * a / (a + b)) if a else 0
        return math.sqrt(max(0, sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2))

    got = spark.createDataFrame(rows, "p array<double>, q array<double>").select(Q.distance(F.col("p"), F.col("q")).alias("d")).collect()
    assert all(abs(r.d - js(p, q)) < 1e-9 for r, (p, q) in zip(got, rows))


def test_unlike_texts_go_and_usual_or_unknown_ones_stay(spark):
    rows = [(i, "the of and to in " + prose(i, 150) + " the of the and", "en", "s", 1) for i in range(40)]
    odd = [(100, prose(500, 150).upper() + "!!", "en", "s", 1), (101, " ".join(w + "$%*" for w in prose(501, 150).split()), "en", "s", 1)]
    rare = [(102, prose(502, 150).upper(), None, "s", 1)]
    docs = docs_of(spark, rows + odd + rare)
    reference = Q.references(docs)
    assert [r.lang for r in reference.collect()] == ["en"]
    kept = Q.keep_good(docs, reference)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [*range(40), 102]


def test_no_python_runs_and_empty_tables_work(spark):
    docs = messy(spark)
    judged = Q.judge(docs, Q.references(docs), out="verdict")
    assert "Python" not in judged._jdf.queryExecution().executedPlan().toString()
    assert Q.keep_good(empty(spark), Q.references(empty(spark))).count() == 0


def test_rare_languages_are_tested_broadcast_or_not(spark):
    common = docs_of(spark, [(0, "a b", "en", "s", 1)]).drop("doc_id").crossJoin(spark.range(1000, 21000).withColumnRenamed("id", "doc_id"))
    rare = [(i, "the of and to in " + prose(i, 150) + " the of the and", "cy", "s", 1) for i in range(9)]
    odd = [(100, prose(500, 150).upper() + "!!", "cy", "s", 1), (101, prose(501, 150).upper(), None, "s", 1)]
    docs = docs_of(spark, rare + odd).unionByName(common)
    reference = Q.references(docs)
    assert {(r.lang, r.hot) for r in reference.collect()} == {("en", True), ("cy", False)}
    few = Q.Rules(hot_share=0.5, broadcast_bytes=0)
    cold = Q.references(docs, rules=few)
    assert {(r.lang, r.hot) for r in cold.collect()} == {("en", True), ("cy", False)}
    for ref, rules in [(reference, Q.RULES), (cold, few)]:
        out = Q.judge(docs, ref, rules=rules)
        assert out.count() == docs.count() and out.columns == [*docs.columns, "judged"]
        assert {r.doc_id: r.judged.kept for r in out.where("doc_id < 1000").collect()} == {**{i: True for i in range(9)}, 100: False, 101: True}


def test_common_words_of_any_length(spark):
    long = [(i, " ".join(f"{w} gemeinschaftlich" for w in prose(i, 60).split()), "de", "s", 1) for i in range(20)]
    compound = [(100 + i, " ".join(f"{w}zusammengesetzt" for w in prose(i, 60).split()), "fi", "s", 1) for i in range(20)]
    odd = [(200, compound[0][1].upper() + "!!", "fi", "s", 1)]
    bare = [(300, "123 456 " * 40, "xx", "s", 1)]
    docs = docs_of(spark, long + compound + odd + bare)
    reference = {r.lang: r for r in Q.references(docs).collect()}
    assert reference["de"].words[0] == "gemeinschaftlich" and reference["de"].word_share[0] == 0.5
    assert len(reference["fi"].words) == 12 and all(len(w) > 5 for w in reference["fi"].words)
    assert reference["xx"].words == [] and reference["xx"].word_share == [1.0] and len(reference["xx"].class_share) == 7
    judged = {r.doc_id: r.judged for r in Q.judge(docs, Q.references(docs)).collect()}
    assert judged[0].word_distance < 0.28 and not judged[200].kept and judged[100].kept
