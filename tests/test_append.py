"""A feed added to a published run against a load of both, and what makes them differ."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import feed, tuples

from tillroll.operators import lookup
from tillroll.plans import analytics as A
from tillroll.plans.quality import QualityError, constraint_checks, require_passed
from tillroll.plans.retail import append_feed, load_warehouse
from tillroll.sources.schemas import WAREHOUSE_TABLES
from tillroll.sources.warehouse import publish, published_run, read_warehouse, vacuum

FIRST = [
    ("A1", "2024-01-05", "C1", "Ann", "North", "Mat", "Sports", "2", "10.00", "10"),
    ("A2", "2024-01-06", "C2", "", "South", "Ball", "Sports", "1", "12.00", ""),
    ("A3", "2024-02-01", "C1", "Ann", "North", "Hub", "Electronics", "2.5", "50.00", "0"),
    ("A4", "2024-02-01", "C2", "Bob", "", "Net", "Sports", "1", "11.00", "0"),
    ("A5", "2024-02-02", "C2", "Bob", "", "Net", "Sports", "0", "11.00", "0"),
]
SECOND = [
    ("A1", "05/01/2024", "C1", "Anna", "West", "MAT", "Sports", "2", "10.00", "50"),  # copy of a published line
    ("B1", "2024-02-03", "C3", "Cy", "East", "Mat", "Toys", "1", "11.00", "0"),  # known product keeps its category
    ("B2", "2024-03-01", "C2", "Bobby", "North", "Cap", "Sports", "1", "900.00", "0"),  # outlier by the older prices
    ("B2", "2024-03-01", "C2", "Bobby", "North", "Cap", "Sports", "1", "900.00", "0"),
    ("A3", "2024-02-01", "C1", "Ann", "North", "Hub", "Electronics", "2.7", "50.00", "0"),  # only whole quantities agree
    ("B3", "2023-12-31", "C4", "Di", "Oslo", "Cup", "Electronics", "3", "50.00", "0"),
    ("B4", "bad", "C5", "Ed", "Oslo", "Cup", "Electronics", "3", "50.00", "0"),
]


def everything(wh):
    tables = {name: sorted(tuples(wh[name], "*"), key=str) for name in WAREHOUSE_TABLES}
    return tables | {q.__name__: sorted(tuples(q(wh), "*"), key=str) for q in (A.sales_flat, A.customer_segments, A.monthly_kpis)}


def months(wh):
    return sorted(tuples(wh.monthly, "year", "month", "month_name", "orders", "revenue", "profit", "avg_order_value"))


@pytest.mark.parametrize("broadcast_bytes", [lookup.BROADCAST_BYTES, 0])
def test_a_feed_added_equals_a_load_of_both(spark, tmp_path, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr("tillroll.operators.positions.BROADCAST_BYTES", broadcast_bytes)
    both = load_warehouse(feed(spark, FIRST + SECOND), str(tmp_path / "both"))
    root = str(tmp_path / "added")
    load_warehouse(feed(spark, FIRST), root)
    added = append_feed(feed(spark, SECOND), root, report=str(tmp_path / "report"))
    assert (added.n_lines, added.n_overtaken) == (4, 0)
    wh = read_warehouse(spark, root)
    assert everything(wh) == everything(both)
    assert months(wh) == months(both)
    require_passed(constraint_checks(wh))
    report = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert "input_rows                    : 7" in report and "duplicate_rows_removed        : 2" in report
    assert "fact_sales                    : 8" in report


def test_feeds_are_added_one_after_the_other(spark, tmp_path):
    # Without the outlier: copies of it in two feeds would be capped by two medians, and both stay.
    root, lines = str(tmp_path / "added"), FIRST + SECOND[:2] + SECOND[4:]
    load_warehouse(feed(spark, lines[:4]), root)
    for begin, end in ((4, 7), (7, 10)):
        append_feed(feed(spark, lines[begin:end]), root)
    # Feeds without new lines, or without lines, and one that fails a check.
    assert [append_feed(feed(spark, more), root).n_lines for more in (lines[:2], [])] == [0, 0]
    nameless = ("B9", "2024-07-02", "", "Cy", "West", "Net", "Sports", "1", "5.00", "0")
    with pytest.raises(QualityError, match="customer_id not null"):
        append_feed(feed(spark, [nameless]), root)
    wh = read_warehouse(spark, root)
    both = load_warehouse(feed(spark, lines), str(tmp_path / "both"))
    assert everything(wh) == everything(both) and months(wh) == months(both)
    # All parts of the published run stay.
    assert published_run(spark, root).count("+") == 4 == len(list((tmp_path / "added" / "runs").iterdir())) - 1
    assert vacuum(spark, root, keep=1) == []


def test_published_prices_stay_and_are_counted_when_medians_move(spark, tmp_path):
    def lines(first, prices):
        return [(f"O{first + i}", "2024-01-05", "C1", "Ann", "North", "Mat", "Sports", "1", str(p), "0") for i, p in enumerate(prices)]

    old, new = lines(0, [10, 10, 10, 60, 45]), lines(5, [8, 8, 8, 8, 8, 8])
    root = str(tmp_path)
    load_warehouse(feed(spark, old), root)
    added = append_feed(feed(spark, new), root)
    # The median falls from 10 to 8: the line of 60, capped to 10, and that of 45 would both be 8 now.
    assert (added.n_lines, added.n_overtaken) == (6, 2)
    prices = [float(r[0]) for r in tuples(read_warehouse(spark, root)["fact_sales"].orderBy("sale_key"), "unit_price")]
    assert prices == [10, 10, 10, 10, 45, 8, 8, 8, 8, 8, 8]


def test_nothing_to_add_to(spark, tmp_path):
    with pytest.raises(ValueError, match="load a feed first"):
        append_feed(feed(spark, FIRST), str(tmp_path))


def test_feeds_added_at_once_are_both_there(spark, tmp_path):
    root = str(tmp_path / "added")
    load_warehouse(feed(spark, FIRST), root)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda lines: append_feed(feed(spark, lines), root), [SECOND[:2], SECOND[4:]]))
    wh = read_warehouse(spark, root)
    assert wh.rows("fact_sales") == 7
    assert published_run(spark, root).count("+") == 2
    require_passed(constraint_checks(wh))


def test_a_run_that_adds_must_be_the_next(spark, tmp_path):
    root = str(tmp_path)
    assert publish(spark, root, "a") == 1
    assert publish(spark, root, "a+b", after=1) == 2
    assert publish(spark, root, "a+c", after=1) is None and published_run(spark, root) == "a+b"
    # One that has taken its number may still write its name.
    (tmp_path / "published" / f"{3:012}").touch()
    assert publish(spark, root, "a+b+d", after=2) is None

