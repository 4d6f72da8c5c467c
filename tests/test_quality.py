"""Every check must fail on a row built to break it, and a broken load must not be published."""

from datetime import date
from decimal import Decimal
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier

import pytest
from helpers import MINI_FEED, feed, tuples

from tillroll.plans import quality as Q
from tillroll.plans.retail import load_warehouse
from tillroll.sources.schemas import WAREHOUSE_TABLES
from tillroll.sources.warehouse import Warehouse, publish, published_run, read_warehouse, vacuum

FACT = {
    "sale_key": 1, "order_id": "O1", "customer_key": 1, "product_key": 1, "region_key": 1, "date_key": 20240601,
    "payment_method": None, "sales_channel": None, "quantity": 1, "unit_price": Decimal("2.00"),
    "discount_percent": Decimal("0.00"), "gross_amount": Decimal("2.00"), "discount_amount": Decimal("0.00"),
    "net_amount": Decimal("2.00"), "cost_amount": Decimal("1.00"), "profit_amount": Decimal("1.00"),
}
DIMS = {
    "dim_customer": [(1, "C1", "Ann")],
    "dim_product": [(1, "Mat", "Sports")],
    "dim_region": [(1, "North")],
    "dim_date": [(20240601, date(2024, 6, 1), 2024, 2, 6, "June", 1, "Saturday")],
}


def warehouse(spark, facts=(), **dims):
    rows = [tuple({**FACT, **change}.values()) for change in ({}, *facts)]
    data = {**DIMS, **dims, "fact_sales": rows}
    return Warehouse({n: spark.createDataFrame(data[n], schema) for n, schema in WAREHOUSE_TABLES.items()})


def failures(checks):
    return {name: n for name, n, status in tuples(checks, "check_name", "violations", "status") if status == "FAIL"}


def test_a_sound_warehouse_passes(spark):
    wh = warehouse(spark, [{"sale_key": 2, "order_id": "O2"}])
    assert failures(Q.warehouse_checks(wh)) == {} and failures(Q.constraint_checks(wh)) == {}
    assert len(Q.require_passed(Q.warehouse_checks(wh))) == 8


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({"customer_key": None}, {Q.V1: 1, Q.V7: 1}),
        ({"product_key": None}, {Q.V2: 1, Q.V8: 1}),
        ({"quantity": 0}, {Q.V3: 1}),
        ({"unit_price": Decimal("0.00")}, {Q.V4: 1}),
        ({"net_amount": Decimal("1.50")}, {Q.V5: 1}),
        ({"net_amount": Decimal("2.01")}, {}),
        ({"order_id": "O1", "quantity": 3}, {Q.V6: 1}),
        ({"customer_key": 9}, {Q.V7: 1}),
        ({"product_key": 9}, {Q.V8: 1}),
    ],
)
def test_each_check_can_fail(spark, change, expected):
    wh = warehouse(spark, [{"sale_key": 2, "order_id": "O2", **change}])
    assert failures(Q.warehouse_checks(wh)) == expected


@pytest.mark.parametrize(
    ("facts", "dims", "expected"),
    [
        ([{"sale_key": 1}], {}, {"fact_sales: sale_key unique": 1}),
        ([{"sale_key": 2, "order_id": None}], {}, {"fact_sales: order_id not null": 1}),
        ([{"sale_key": 2, "quantity": -1}], {}, {"fact_sales: quantity > 0": 1}),
        ([{"sale_key": 2, "region_key": 5}], {}, {"fact_sales: region_key in dim_region": 1}),
        ([{"sale_key": 2, "date_key": 19990101}], {}, {"fact_sales: date_key in dim_date": 1}),
        ([], {"dim_customer": [(1, "C1", "Ann"), (2, "C1", "Bob")]}, {"dim_customer: customer_id unique": 1}),
        ([], {"dim_product": [(1, "Mat", None)]}, {"dim_product: category not null": 1}),
    ],
)
def test_constraints(spark, facts, dims, expected):
    assert failures(Q.constraint_checks(warehouse(spark, facts, **dims))) == expected


@pytest.mark.parametrize(
    ("keys", "gapless"),
    [
        ([], True), ([7], True), ([3, 1, 2], True), ([5, None, 4, 6, None], True), ([-1, 0, 1], True), ([None], True),
        ([1, 1, 3], False), ([1, 2, 2, 4], False), ([1, 1, 4, 4], False), ([1, 3], False), ([2, 2], False), ([1, 2, 2, 2, 5], False),
    ],
)
def test_gapless_keys_are_proven(spark, keys, gapless):
    assert Q.is_gapless(spark.createDataFrame([(k,) for k in keys], "sale_key bigint"), "sale_key") == gapless
    assert Q.is_gapless(spark.createDataFrame([(k,) for k in keys], "sale_key int"), "sale_key") == gapless


def test_numbered_lines_are_not_shuffled_to_prove_them_unique(spark):
    def plan(keys):
        wh = warehouse(spark, [{"sale_key": k, "order_id": f"O{k}"} for k in keys])
        return Q.constraint_checks(wh)._jdf.queryExecution().executedPlan().toString()

    assert "hashpartitioning(sale_key" not in plan(range(2, 9))
    assert "hashpartitioning(sale_key" in plan([2, 9])


def test_a_broken_load_is_not_published(spark, tmp_path):
    root = str(tmp_path)
    load_warehouse(feed(spark, MINI_FEED), root)
    nameless = ("ORD10", "2024-07-02", "", "Cy Poe", "West", "Net", "Sports", "1", "5.00", "0")
    too_large = ("ORD11", "2024-07-02", "C9", "Cy Poe", "West", "Net", "Toys", "9e9", "9e9", "0")
    with pytest.raises(Q.QualityError, match="customer_id not null.*quantity not null"):
        load_warehouse(feed(spark, [*MINI_FEED, nameless, too_large]), root)
    assert read_warehouse(spark, root).rows("fact_sales") == 5
    load_warehouse(feed(spark, MINI_FEED[:3]), root)
    assert read_warehouse(spark, root).rows("fact_sales") == 3


def staging_folders(spark):
    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")).glob("staging-*")}


def test_loads_leave_no_staging_and_failed_ones_no_run(spark, tmp_path):
    before, root = staging_folders(spark), str(tmp_path)
    load_warehouse(feed(spark, MINI_FEED), root)
    nameless = ("ORD10", "2024-07-02", "", "Cy Poe", "West", "Net", "Sports", "1", "5.00", "0")
    with pytest.raises(Q.QualityError):
        load_warehouse(feed(spark, [*MINI_FEED, nameless]), root)
    assert staging_folders(spark) == before
    assert len(list((tmp_path / "runs").iterdir())) == 1


def test_vacuum_keeps_the_last_runs_by_number(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for n in (10, 3, 10):
        load_warehouse(feed(spark, MINI_FEED[:n]), root)
    last = published_run(spark, root)
    assert len(vacuum(spark, root, keep=2)) == 1
    assert len(vacuum(spark, root, keep=1)) == 1
    assert [p.name for p in (tmp_path / "runs").iterdir()] == [last]
    assert read_warehouse(spark, root).rows("fact_sales") == 5


def test_loads_that_end_at_once_get_numbers_of_their_own(spark, tmp_path):
    for attempt in range(20):
        root, ready = str(tmp_path / str(attempt)), Barrier(8)

        def end(i, root=root, ready=ready):
            ready.wait()
            return publish(spark, root, f"run{i}")

        with ThreadPoolExecutor(8) as pool:
            numbers = list(pool.map(end, range(8)))
        assert sorted(numbers) == list(range(1, 9))
        assert published_run(spark, root) == f"run{numbers.index(8)}"


def test_a_number_without_a_run_means_nothing(spark, tmp_path):
    root = str(tmp_path)
    assert publish(spark, root, "a") == 1
    (tmp_path / "published" / f"{2:012}").touch()  # a load that died between taking the number and writing its name
    assert published_run(spark, root) == "a"
    assert publish(spark, root, "b") == 3 and published_run(spark, root) == "b"


def test_bounds_decide_on_foreign_keys_where_dimension_keys_are_dense(spark):
    customers = [(k, f"C{k}", "Ann") for k in (1, 2, 3)]
    wh = warehouse(spark, [{"sale_key": 2, "order_id": "O2", "customer_key": 4}, {"sale_key": 3, "order_id": "O3", "customer_key": 0}], dim_customer=customers)
    assert wh.dense_keys("dim_customer", "customer_key") == 3 and wh.dense_keys("dim_product", "product_key") == 1
    assert failures(Q.warehouse_checks(wh)) == {Q.V7: 2}
    assert "LeftAnti" not in Q.warehouse_checks(wh)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keys", [(1, 3), (1, 1, 3), (2, 3), ()])
def test_sparse_dimension_keys_are_looked_for(spark, keys):
    wh = warehouse(spark, [{"sale_key": 2, "order_id": "O2", "customer_key": 2}], dim_customer=[(k, f"C{i}", "Ann") for i, k in enumerate(keys)])
    assert wh.dense_keys("dim_customer", "customer_key") is None
    missing = sum(k not in keys for k in (1, 2))
    assert failures(Q.warehouse_checks(wh)).get(Q.V7, 0) == missing


def test_a_file_of_the_fact_is_in_order_of_customers(spark, tmp_path):
    load_warehouse(feed(spark, MINI_FEED * 3), str(tmp_path))
    for file in tmp_path.glob("runs/*/fact_sales/*/*.parquet"):
        keys = [r[0] for r in spark.read.parquet(str(file)).select("customer_key").collect()]
        assert keys == sorted(keys)
