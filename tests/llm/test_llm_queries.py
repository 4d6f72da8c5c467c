"""Registered queries against their SQL, and the pipeline stage by stage."""

import math
import zlib
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from llm_data import docs_of, empty, messy, prose

from tillroll.llm import queries
from tillroll.operators.staging import Staging

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(rows):
    cell = lambda v: "null" if v is None or isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(tuple(map(cell, row)) for row in rows)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, tables, name):
    got = queries.QUERIES[name](spark, str(SF_DIR))
    expected = tables.execute(queries.ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(got.columns) == sorted(columns)
    assert canonical(got.select(*columns).collect()) == canonical(expected.fetchall())


def rule_rows():
    """Texts on which rules can go wrong: long common words, a language of one document in thousands, none with a letter."""
    shared = "zusammengehörigkeit gemeinschaftlich Σ der die und"
    rows = [(i, f"{prose(i, 90)} " + " ".join([shared] * 20), "de", "s", 1) for i in range(30)]
    rows += [(100 + i, " ".join(f"{w}yksityiskohta" for w in prose(i, 60).split()), "fi", "s", 1) for i in range(15)]
    rows += [(200, prose(900, 120), "de", "s", 1), (201, (prose(901, 70) + " ") * 2 + shared.upper(), "de", "s", 1), (202, "123 456\n789 " * 60, "xx", "s", 1)]
    rows += [(203, prose(902, 150), "cy", "s", 1), (204, "ÀÉ \u00a0x\x00y " * 40, "cy", "s", 1), (205, prose(903, 150), None, "s", 1)]
    return rows + [(1000 + i, "the a of", "en", "s", 1) for i in range(2500)]


def test_rules_equal_their_sql_where_words_are_long_and_languages_rare(spark, tmp_path):
    docs_of(spark, rule_rows()).unionByName(messy(spark)).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.execute(queries.ORACLES["op4_quality_rules"])
    columns = [c[0] for c in expected.description]
    got = queries.op4_quality_rules(spark, str(tmp_path)).select(*columns).collect()
    assert canonical(got) == canonical(expected.fetchall())
    assert {r.kept for r in got if r.n_words >= 100} == {True, False}


@pytest.mark.parametrize(("name", "modulus", "out"), [("op5_quality_fm", 5, 0), ("op9_toxicity_instances", 4, 2), ("op6_language_hypervectors", 4, 2)])
def test_folds(spark, name, modulus, out):
    rows = queries.QUERIES[name](spark, str(SF_DIR)).collect()
    assert len(rows) == 200
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == out) and 0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables whose documents are messy, for stages that look at other tables."""
    out = tmp_path_factory.mktemp("tables")
    rows = [(i, f"the {prose(i, 90)}. the end", "en", "s", 1) for i in range(100, 140)]
    docs = docs_of(spark, rows)
    docs.unionByName(messy(spark)).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(100, 140)], "doc_id bigint, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, prose(100, 90)), (2, None)], "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_messy_and_empty_documents(spark, folder, stage):
    docs = Staging(spark).write(messy(spark), "messy")
    out = stage(spark, docs, folder)
    assert out.columns[: len(docs.columns)] == docs.columns
    assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}
    assert stage(spark, empty(spark), folder).count() == 0


def test_pipeline_equals_its_stages_one_by_one(spark, folder):
    docs = queries.table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = Staging(spark).write(stage(spark, docs, folder), "next")
    got = corpus_pipeline.run(spark, folder)
    assert canonical(got.collect()) == canonical(docs.select(*got.columns).collect()) and not got.isEmpty()
    texts = [r.text for r in got.collect()]
    assert len({t for t in texts}) <= len(texts) and not any("the end" in t and prose(100, 90) in t for t in texts)
