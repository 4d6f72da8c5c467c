"""What the plans must and must not contain."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from harness.registry import QUERIES
from harness.workspace import workspace
from tillroll.plans import analytics as A
from tillroll.plans.cleaning import drop_invalid

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def ws(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return workspace(spark, str(SF_DIR))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_cross_join(ws, name):
    text = plan(QUERIES[name](ws))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_monthly_revenue_reads_two_fact_columns(ws):
    text = plan(A.monthly_revenue(ws.load.warehouse))
    assert "ReadSchema: struct<date_key:int,net_amount:decimal(14,2)>" in text


def test_validity_filter_reaches_the_scan(ws):
    text = plan(drop_invalid(ws.typed))
    assert "GreaterThan(quantity,0.0)" in text and "GreaterThan(unit_price,0.0)" in text


def test_year_filter_on_the_flat_view_prunes_fact_partitions(ws):
    text = plan(A.sales_flat(ws.load.warehouse).where(F.col("year") == 1996))
    assert "PartitionFilters: [isnotnull(sale_year" in text


def test_the_load_moves_whole_lines_once_before_the_fact_and_sorts_none_for_dimensions(ws):
    plans = ws.load.plans
    assert plans["clean"].count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plans["clean"]
    # Lines that go are left out before the shuffle, and amounts derived behind it.
    behind, before = plans["clean"].split("Exchange hashpartitioning", 1)
    assert "getbit" in before and "gross_amount" in behind and "gross_amount" not in before
    # Hashes and positions only; no plan holds a bound per range.
    hashes = plans["first_lines-hashes"]
    assert hashes.count("Exchange hashpartitioning") == 1 and all(len(text) < 30_000 for text in plans.values())
    for name in ("firsts_customer_id", "firsts_product_name"):
        assert "SortAggregate" not in plans[name] and "HashAggregate" in plans[name]
    for text in plans.values():
        assert "CartesianProduct" not in text and "Python" not in text


def test_views_over_large_dimensions_are_defined_without_work(ws, monkeypatch):
    monkeypatch.setattr("tillroll.operators.lookup.BROADCAST_BYTES", 0)
    written = []
    monkeypatch.setattr("tillroll.operators.staging.Staging.write", lambda *a: written.append(a))
    A.register_views(ws.load.warehouse)
    assert not written
    assert "PartitionFilters: [isnotnull(sale_year" in plan(ws.spark.sql("SELECT * FROM vw_sales_flat WHERE year = 1996"))


def test_fact_is_aggregated_before_it_meets_a_dimension(ws):
    for query in (A.category_profit, A.top_product, A.region_share, A.customer_segments):
        lines = plan(query(ws.load.warehouse)).splitlines()
        scan = next(i for i, text in enumerate(lines) if "net_amount:decimal" in text)
        nearest = next(text for text in reversed(lines[:scan]) if "Aggregate" in text or "Join" in text)
        assert "HashAggregate" in nearest and "partial_sum" in nearest
