"""FIXTURES.md, section 3: ten hand-written lines through every stage, expected values by hand."""

from datetime import date
from decimal import Decimal

import pytest
from helpers import MINI_FEED, feed, tuples
from pyspark.sql import functions as F

from tillroll.operators import lookup
from tillroll.operators.staging import Staging
from tillroll.plans import analytics as A
from tillroll.plans.quality import constraint_checks, dq_metrics, load_counts, warehouse_checks
from tillroll.plans import retail
from tillroll.sources.reports import TITLE, write_report
from tillroll.sources.schemas import WAREHOUSE_TABLES
from tillroll.sources.warehouse import read_warehouse


def d(text):
    return Decimal(text)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("warehouse"))


@pytest.fixture(scope="module")
def load(spark, root):
    return retail.load(feed(spark, MINI_FEED), root, Staging(spark))


@pytest.fixture(scope="module")
def wh(spark, load, root):
    return read_warehouse(spark, root)


def test_metrics(load):
    assert {m: v for m, v in tuples(dq_metrics(load.cleaned), "metric", "value")} == {
        "input_rows": 10, "invalid_dates": 1, "missing_customer_name": 2, "missing_region": 1, "missing_quantity": 0,
        "missing_unit_price": 1, "rows_dropped_invalid": 4, "price_outliers_capped": 1, "duplicate_rows_removed": 1,
        "output_rows": 5,
    }


def test_clean_lines(load):
    columns = ["line_no", "order_date", "customer_name", "region", "product_name", "category", "unit_price",
               "gross_amount", "discount_amount", "net_amount", "cost_amount", "profit_amount"]
    assert tuples(load.cleaned.lines.orderBy("line_no"), *columns) == [
        (1, date(2024, 6, 1), "Ann Lee", "North", "Yoga Mat", "Sports", 10.0, 20.0, 2.0, 18.0, 11.6, 6.4),
        (2, date(2024, 12, 1), "Unknown Customer", "South", "Yoga Mat", "Sports", 12.0, 12.0, 0.0, 12.0, 6.96, 5.04),
        (3, date(2024, 6, 15), "Ann Lee", "Unspecified", "Football", "Sports", 20.0, 60.0, 0.0, 60.0, 34.8, 25.2),
        (4, date(2025, 8, 15), "Bob Ray", "East", "Football", "Sports", 12.0, 12.0, 0.6, 11.4, 6.96, 4.44),
        (5, date(2024, 7, 2), "Unknown Customer", "West", "Usb-C Hub", "Electronics", 50.25, 50.25, 10.05, 40.2, 34.17, 6.03),
    ]


def test_tables(wh):
    assert {name: wh.rows(name) for name in WAREHOUSE_TABLES} == {
        "dim_customer": 3, "dim_product": 3, "dim_region": 5, "dim_date": 5, "fact_sales": 5,
    }
    # Keys count first appearances; the first line of C2 has no name.
    assert sorted(tuples(wh["dim_customer"], "*")) == [(1, "C1", "Ann Lee"), (2, "C2", "Unknown Customer"), (3, "C3", "Unknown Customer")]
    assert sorted(tuples(wh["dim_product"], "*")) == [(1, "Yoga Mat", "Sports"), (2, "Football", "Sports"), (3, "Usb-C Hub", "Electronics")]
    assert [r[1] for r in sorted(tuples(wh["dim_region"], "*"))] == ["North", "South", "Unspecified", "East", "West"]
    fact = wh["fact_sales"].drop("sale_year").orderBy("sale_key")
    assert {f.name: f.dataType for f in fact.schema} == {f.name: f.dataType for f in WAREHOUSE_TABLES["fact_sales"]}
    assert tuple(fact.first()) == (
        1, "ORD1", 1, 1, 1, 20240601, "UPI", "Online", 2, d("10.00"), d("10.00"), d("20.00"), d("2.00"), d("18.00"),
        d("11.60"), d("6.40"),
    )


def test_checks_pass(wh):
    for checks, n in ((warehouse_checks(wh), 8), (constraint_checks(wh), 44)):
        rows = tuples(checks, "violations", "status")
        assert rows == [(0, "PASS")] * n


def test_monthly_revenue(wh):
    assert tuples(A.monthly_revenue(wh), "*") == [
        (2024, "June", d("78.00"), None, None),
        (2024, "July", d("40.20"), d("78.00"), d("-48.46")),
        (2024, "December", d("12.00"), d("40.20"), d("-70.15")),
        (2025, "August", d("11.40"), d("12.00"), d("-5.00")),
    ]


def test_category_profit(wh, monkeypatch):
    expected = [("Sports", d("101.40"), d("41.08"), d("40.51"), 1), ("Electronics", d("40.20"), d("6.03"), d("15.00"), 2)]
    assert tuples(A.category_profit(wh), "*") == expected
    monkeypatch.setattr(A, "SMALL_ROWS", 0)
    assert tuples(A.category_profit(wh), "*") == expected


def test_top_product(wh):
    assert tuples(A.top_product(wh), "*") == [("Sports", "Football", d("71.40"), 4), ("Electronics", "Usb-C Hub", d("40.20"), 1)]


def test_region_share(wh, monkeypatch):
    expected = [
        ("Unspecified", 1, d("60.00"), d("60.00"), d("42.37")),
        ("West", 1, d("40.20"), d("40.20"), d("28.39")),
        ("North", 1, d("18.00"), d("18.00"), d("12.71")),
        ("South", 1, d("12.00"), d("12.00"), d("8.47")),
        ("East", 1, d("11.40"), d("11.40"), d("8.05")),
    ]
    assert tuples(A.region_share(wh), "*") == expected
    monkeypatch.setattr(A, "SMALL_ROWS", 0)
    assert tuples(A.region_share(wh), "*") == expected


def test_customer_segments(wh):
    assert tuples(A.customer_segments(wh), "customer_id", "order_count", "lifetime_value", "last_purchase_date", "customer_segment") == [
        ("C1", 2, d("78.00"), date(2024, 6, 15), "Occasional"),
        ("C3", 1, d("40.20"), date(2024, 7, 2), "One-time"),
        ("C2", 2, d("23.40"), date(2025, 8, 15), "Occasional"),
    ]


def test_top_customers(wh):
    assert tuples(A.top_customers(wh, 2), "customer_id") == [("C1",), ("C3",)]


def test_repeat_share(wh):
    customers, revenue = A.repeat_share(wh).first()
    assert (round(customers, 4), round(revenue, 4)) == (66.6667, 71.6102)


def test_views(spark, wh):
    A.register_views(wh)
    assert spark.table("vw_sales_flat").columns == A.FLAT_COLUMNS
    assert spark.table("vw_sales_flat").count() == 5
    assert tuples(spark.table("vw_monthly_kpis").orderBy("year", "month"), "*") == [
        (2024, 6, "June", 2, d("78.00"), d("31.60"), d("39.00")),
        (2024, 7, "July", 1, d("40.20"), d("6.03"), d("40.20")),
        (2024, 12, "December", 1, d("12.00"), d("5.04"), d("12.00")),
        (2025, 8, "August", 1, d("11.40"), d("4.44"), d("11.40")),
    ]


def test_report(spark, load, wh, tmp_path):
    write_report(dq_metrics(load.cleaned), load_counts(wh), str(tmp_path / "report"))
    (file,) = (tmp_path / "report").glob("part-*.txt")
    lines = file.read_text(encoding="utf-8").splitlines()
    assert lines[0] == TITLE
    assert "input_rows                    : 10" in lines
    assert lines[-1] == "fact_sales                    : 5"
    assert lines.index("-- Transform stage findings --") < lines.index("-- Final row counts loaded into warehouse --")


@pytest.mark.parametrize("partitions", [1, 7])
def test_results_do_not_depend_on_the_layout(spark, load, wh, tmp_path, partitions):
    shuffled = feed(spark, MINI_FEED, partitions).orderBy(F.rand(seed=partitions))
    again = retail.load(shuffled, str(tmp_path), Staging(spark)).warehouse
    for name in WAREHOUSE_TABLES:
        assert sorted(tuples(again[name], "*"), key=str) == sorted(tuples(wh[name], "*"), key=str)


def skewed_lines(n):
    """A third of the lines on one customer and product, many of them copies, the rest spread thin."""
    for i in range(n):
        hot = i % 3 == 0
        yield (
            f"O{i // 50 if hot else i}", f"2024-{i % 12 + 1:02}-{i % 28 + 1:02}", "HOT" if hot else f"C{i % 400}",
            ["", "Ann", "Bob"][i % 3], ["North", "south ", ""][i % 3], "Mat" if hot else f"p{i % 90}",
            ["Sports", "Toys", ""][i % 7 % 3] or "Beauty", str(i % 4), str((i * 37) % 1000 / 4), str(i % 30),
        )


def test_tables_beyond_the_broadcast_bound_give_the_same(spark, tmp_path, monkeypatch):
    raw = feed(spark, list(skewed_lines(3000)), 6)
    small = retail.load(raw, str(tmp_path / "small"), Staging(spark)).warehouse
    expected = {q.__name__: tuples(q(small), "*") for q in (A.customer_segments, A.sales_flat)}
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "HOT_KEYS", 20)
    large = retail.load(raw, str(tmp_path / "large"), Staging(spark)).warehouse
    for name in WAREHOUSE_TABLES:
        assert sorted(tuples(large[name], "*"), key=str) == sorted(tuples(small[name], "*"), key=str)
    for q in (A.customer_segments, A.sales_flat):
        assert sorted(tuples(q(large), "*"), key=str) == sorted(expected[q.__name__], key=str)
