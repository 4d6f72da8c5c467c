"""What moves where lines are sorted, numbered and written: nothing wider than it must, and the same rows."""

import re
import time
from pathlib import Path

import pytest
from helpers import MINI_FEED, feed, tuples
from pyspark.sql import functions as F

from harness.feed import feed_in_order, messy_feed
from harness.workspace import workspace
from tillroll.functions.numbers import derive_amounts
from tillroll.operators import lookup as lookup_module
from tillroll.operators import positions
from tillroll.operators.firsts import first_positions, first_values, key_hashes
from tillroll.operators.lookup import measured_bytes
from tillroll.operators.positions import block_place, keep_numbered, number_kept, position_sets
from tillroll.operators.staging import Staging
from tillroll.plans import analytics, star
from tillroll.plans.cleaning import typed_lines
from tillroll.plans.retail import load
from tillroll.plans.star import customers, fact, products, regions
from tillroll.session import SETTINGS, TASK_BYTES, tune
from tillroll.sources.feed import read_feed, write_csv
from tillroll.sources.schemas import FACT_SALES, ORDINAL
from tillroll.sources.warehouse import SALE_YEAR, Warehouse

SF_DIR = Path("/root/testdata/sf0.001")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def unbroadcast(spark, monkeypatch):
    monkeypatch.setattr(positions, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def numbered_rows(spark, n=70_000):
    chosen = F.col("id").isin([0, 7, 1023, 1024, 32_767, 32_768]) | (F.col("id") % 9 == 4) & ~F.col("id").between(2000, 40_000)
    rows = spark.range(n).select(F.col("id").alias("position"), (F.col("id") * 7).alias("v"), chosen.alias("chosen"))
    return rows, rows.where("chosen").select("position")


def test_rows_are_numbered_where_they_are(spark, staging):
    rows, chosen = numbered_rows(spark)
    got = number_kept(rows, position_sets(chosen, staging, "chosen"), "n")
    assert "Exchange" not in plan(got).replace("BroadcastExchange", "").split("position_slice", 1)[0]
    expected = [(p, p * 7, i) for i, (p,) in enumerate(sorted(tuples(chosen, "position")), 1)]
    assert sorted(tuples(got, "position", "v", "n")) == expected


def test_rows_are_numbered_alike_beyond_the_broadcast_bound(spark, staging, unbroadcast):
    rows, chosen = numbered_rows(spark)
    sets = position_sets(chosen, staging, "chosen")
    assert sorted(tuples(number_kept(rows, sets, "n"), "position", "n")) == sorted(tuples(keep_numbered(rows, sets, "n"), "position", "n"))


def copies(spark):
    rows = spark.range(4000).select(F.col("id").alias("position"), F.when(F.col("id") % 50 != 1, F.col("id") % 2500).alias("k"))
    return rows.repartition(5), {min(p for p in range(4000) if (p % 50 != 1 and p % 2500 == k)) for k in range(2500) if k % 50 != 1} | {1}


def test_first_rows_beyond_the_broadcast_bound_move_only_where_copies_may_be(spark, staging, unbroadcast):
    rows, firsts = copies(spark)
    sets = first_positions(rows, ["k"], staging, "firsts")
    assert {p for (p,) in tuples(keep_numbered(rows, sets, "n"), "position")} == firsts
    assert "firsts-filter" in staging.plans


def test_only_rows_that_pass_the_filter_of_hashes_are_shuffled(spark, staging, unbroadcast):
    rows, _ = copies(spark)
    first_positions(rows, ["k"], staging, "firsts")
    behind, before = staging.plans["firsts"].split("Exchange hashpartitioning(_h1", 1)
    assert "getbit" in before and "getbit" not in behind


def test_payloads_of_other_rows_than_the_first_are_not_shuffled(spark, staging, unbroadcast):
    df = spark.range(5000).select((F.col("id") % 40).alias("k"), F.col("id").alias("o"), (F.col("id") * 3).alias("v")).where("o <> 7").repartition(4)
    got = first_values(df, "k", ["v"], "o", staging)
    firsts = {k: k + 40 * (k == 7) for k in range(40)}
    assert sorted(tuples(got, "k", "v", "first_line", "n_lines")) == [(k, 3 * o, o, 125 - (k == 7)) for k, o in firsts.items()]
    exchanges = plan(got).split("Exchange hashpartitioning(first_line")
    assert len(exchanges) == 3 and any("getbit" in text for text in exchanges[1:])


def test_lines_go_to_large_dimensions_without_amounts_and_give_the_same_fact(spark, staging, monkeypatch, unbroadcast):
    numbers = F.col("id").cast("double")
    lines = spark.range(300).select(
        (F.col("id") + 1).alias("line_no"), F.concat(F.lit("o"), "id").alias("order_id"), F.lit("1997-02-03").cast("date").alias("order_date"),
        F.concat(F.lit("c"), F.col("id") % 30).alias("customer_id"), F.lit("n").alias("customer_name"), F.lit("r").alias("region"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("p"), F.col("id") % 70)).alias("product_name"), F.when(F.col("id") % 5 > 0, "Beauty").alias("category"),
        (numbers + 1).alias("quantity"), (numbers + 0.37).alias("unit_price"), (numbers % 30).alias("discount_percent"), F.lit("m").alias("payment_method"),
        F.lit("s").alias("sales_channel"))
    clean = staging.write(derive_amounts(lines), "lines")
    dims = [staging.write(customers(clean, staging), "c"), staging.write(products(clean, staging), "p"), staging.write(regions(clean, staging), "r").withColumnRenamed("region", "region_name")]
    small = sorted(map(tuple, fact(clean, *dims).collect()))
    monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", 0)
    large = fact(clean, *dims)
    assert sorted(map(tuple, large.collect())) == small and len(small) == 300
    behind, before = plan(large).split("Exchange hashpartitioning(_cold_key", 1)
    assert "rint" in behind and "rint" not in before


def few_lines(spark, staging, name="few"):
    lines = spark.range(60).select(
        (F.col("id") + 1).alias("line_no"), F.concat(F.lit("o"), "id").alias("order_id"), F.lit("1997-02-03").cast("date").alias("order_date"),
        F.concat(F.lit("c"), F.col("id") % 7).alias("customer_id"), F.lit("n").alias("customer_name"), F.lit("r").alias("region"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("p"), F.col("id") % 11)).alias("product_name"), F.lit("Beauty").alias("category"),
        F.lit(2.0).alias("quantity"), F.lit(3.5).alias("unit_price"), F.lit(0.0).alias("discount_percent"), F.lit("m").alias("payment_method"),
        F.lit("s").alias("sales_channel"))
    clean = staging.write(derive_amounts(lines), name)
    dims = [staging.write(customers(clean, staging), "fc"), staging.write(products(clean, staging), "fp"), staging.write(regions(clean, staging), "fr").withColumnRenamed("region", "region_name")]
    return clean, dims


def test_texts_of_keys_are_neither_broadcast_nor_moved_for_the_fact(spark, staging, monkeypatch, unbroadcast):
    clean, dims = few_lines(spark, staging)
    monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", 0)
    moved = [line for line in plan(fact(clean, *dims)).splitlines() if "Exchange hashpartitioning(_cold_key" in line]
    assert moved and not any("_name" in line or "customer_id#" in line for line in moved)


def test_keys_that_share_a_hash_are_met_by_themselves(spark, staging, monkeypatch):
    clean, dims = few_lines(spark, staging)
    expected = sorted(map(tuple, fact(clean, *dims).collect()), key=str)
    assert {r[3] is None for r in expected} == {True, False}
    monkeypatch.setattr(star, "key_hash", lambda name: F.when(F.col(name).isNotNull(), F.xxhash64(name).bitwiseAND(F.lit(1))))
    assert sorted(map(tuple, fact(clean, *dims).collect()), key=str) == expected


def test_lines_that_large_dimensions_move_are_not_moved_by_year_before(spark, staging, tmp_path, monkeypatch):
    raw = feed(spark, MINI_FEED)
    rows = sorted(map(tuple, load(raw, str(tmp_path / "small"), staging).warehouse["fact_sales"].collect()), key=str)
    monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", 0)
    large = load(raw, str(tmp_path / "large"), Staging(spark))
    assert "REBALANCE" not in large.plans["clean"]
    assert "profit_amount" not in large.plans["clean"] and "profit_amount" in large.cleaned.lines.columns
    assert sorted(map(tuple, large.warehouse["fact_sales"].collect()), key=str) == rows and len(rows) > 3


@pytest.mark.parametrize("bound", ["within", "beyond"])
def test_first_rows_leave_known_keys_out(spark, staging, request, bound):
    if bound == "beyond":
        request.getfixturevalue("unbroadcast")
    rows, firsts = copies(spark)
    known = spark.range(0, 2600, 10).select(F.col("id").alias("k")).select(*key_hashes(["k"]))
    sets = first_positions(rows, ["k"], staging, "firsts", known)
    assert {p for (p,) in tuples(keep_numbered(rows, sets, "n"), "position")} == {p for p in firsts if p == 1 or p % 10}
    # Old and new hashes meet in one shuffle.
    assert staging.plans["firsts-hashes"].count("Exchange hashpartitioning") == 1 and "Join" not in staging.plans["firsts-hashes"]


def test_typing_the_feed_is_code_that_the_jvm_compiles(spark, tmp_path, capsys):
    write_csv(feed(spark, MINI_FEED).drop(ORDINAL), str(tmp_path / "feed"))
    typed_lines(read_feed(spark, str(tmp_path / "feed"))).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < int(SETTINGS["spark.sql.codegen.hugeMethodLimit"])


def test_measured_bytes_counts_binary(spark):
    df = spark.range(3).select(F.encode(F.repeat(F.lit("x"), 1000), "UTF-8").alias("b"))
    assert 3000 <= measured_bytes(df) <= 3200


def test_packed_input_gets_smaller_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    tune(spark, 1 << 40, packing=8)
    assert int(spark.conf.get(key)) == TASK_BYTES // 8
    tune(spark, 3 * TASK_BYTES, packing=8)
    assert int(spark.conf.get(key)) == TASK_BYTES // 8
    tune(spark)
    assert spark.conf.get(key) == before


def source_tables(spark, folder):
    """Lines whose order, customer or product is missing, null or there twice."""
    lines = [(o, p, n, float(n), 10.0 * n, 0.05, "O") for n, (o, p) in enumerate([(3, 1), (1, 2), (1, 1), (2, 2), (2, 2), (None, 1), (4, None), (9, 1), (1, 9), (5, 1)])]
    tables = {
        "lineitem": (lines + lines[1:2], "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_linestatus string"),
        "orders": ([(1, 1, "1996-01-02", "A"), (2, 2, "1996-01-03", "B"), (2, 1, "1997-01-03", "C"), (3, None, "1996-01-02", "D"), (None, 1, "1996-01-02", "E"), (4, 1, None, None), (5, 2, None, None)],
                   "o_orderkey bigint, o_custkey bigint, o_orderdate string, o_orderpriority string"),
        "customer": ([(1, "Ann", 1), (2, None, 1)], "c_custkey bigint, c_name string, c_nationkey int"),
        "part": ([(1, "mat", "SMALL", 9.5), (2, "hub", "ECONOMY", 2.0), (2, "hub 2", None, None)], "p_partkey bigint, p_name string, p_type string, p_retailprice double"),
        "nation": ([(1, 1)], "n_nationkey int, n_regionkey int"),
        "region": ([(1, "ASIA")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_the_sorted_feed_has_the_rows_of_the_feed(spark, tmp_path):
    folder = source_tables(spark, tmp_path)
    feed, in_order = messy_feed(spark, folder), feed_in_order(spark, folder)
    assert in_order.schema == feed.schema
    got = [tuple(r) for r in in_order.collect()]
    assert sorted(got, key=str) == sorted((tuple(r) for r in feed.collect()), key=str) and len(got) > 10
    places = [r[-1] for r in got]
    assert places == sorted(places)


@pytest.mark.skipif(not SF_DIR.exists(), reason="no driver tables")
class TestDriverTables:
    def test_the_sorted_feed_is_in_feed_order(self, spark):
        feed = messy_feed(spark, str(SF_DIR)).orderBy(ORDINAL).collect()
        assert feed_in_order(spark, str(SF_DIR)).collect() == feed

    def test_lines_are_sorted_before_they_are_text(self, spark):
        text = plan(feed_in_order(spark, str(SF_DIR)))
        assert text.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in text
        assert "ORD" not in text.split("Exchange rangepartitioning", 1)[1]

    def test_the_fact_is_written_without_moving_lines_again(self, spark):
        plans = workspace(spark, str(SF_DIR)).load.plans
        assert "REBALANCE" not in plans["fact_sales"] and "REBALANCE" in plans["clean"]


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for folder in folders for p in Path(folder).rglob("shuffle_*")}


def test_shuffle_files_go_with_their_query(spark, staging):
    before = shuffle_files(spark)
    staging.write(spark.range(10_000).repartition(3, "id"), "moved")
    until = time.time() + 30
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_a_load_deletes_what_it_has_read_for_the_last_time(spark, staging, tmp_path, monkeypatch, unbroadcast):
    monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", 0)
    done = load(feed(spark, MINI_FEED), str(tmp_path / "wh"), staging)
    left = {p.name for p in Path(staging.folder).iterdir()}
    assert "clean" in left and not left & {"typed", star.KEYED_LINES} and {"typed", f"{star.KEYED_LINES}/customer_id"} <= set(staging.plans)
    assert done.cleaned.lines.count() == done.warehouse.rows("fact_sales") == 5


def test_one_shuffle_of_the_facts_lines_is_over_before_the_next(spark, staging, monkeypatch, unbroadcast):
    clean, dims = few_lines(spark, staging)
    monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", 0)
    at_once, by_steps = fact(clean, *dims), fact(clean, *dims, staging)
    moves = "Exchange hashpartitioning(_cold_key"
    steps = [plan(by_steps), *(staging.plans[f"{star.KEYED_LINES}/{key}"] for key in ("product_name", "customer_id"))]
    assert plan(at_once).count(moves) == 3 and [text.count(moves) for text in steps] == [1, 1, 1]
    assert sorted(map(tuple, by_steps.collect()), key=str) == sorted(map(tuple, at_once.collect()), key=str)


def odd_amounts(spark):
    """A fact with amounts that follow from others, some that don't, and null ones."""
    dec = "decimal(14,2)"
    lines = spark.range(90).select(
        (F.col("id") + 1).alias("sale_key"), F.concat(F.lit("o"), "id").alias("order_id"), (F.col("id") % 7 + 1).cast("int").alias("customer_key"),
        (F.col("id") % 5 + 1).cast("int").alias("product_key"), F.lit(1).alias("region_key"), F.lit(19970203).alias("date_key"), F.lit("m").alias("payment_method"),
        F.lit("s").alias("sales_channel"), (F.col("id") % 4 + 1).cast("int").alias("quantity"), (F.col("id") * 1.37 + 1).cast("decimal(12,2)").alias("unit_price"),
        F.lit(5).cast("decimal(5,2)").alias("discount_percent"), F.lit(0.31).cast(dec).alias("discount_amount"), F.lit(0.5).cast(dec).alias("cost_amount"))
    amounts = {"gross_amount": "quantity * unit_price", "net_amount": "gross_amount - discount_amount", "profit_amount": "net_amount - cost_amount"}
    for i, (name, value) in enumerate(amounts.items()):
        follows = F.when(F.col("sale_key") % 11 == i, F.lit(None)).when(F.col("sale_key") % 13 == i, F.lit(7.25)).otherwise(F.expr(value))
        lines = lines.withColumn(name, follows.cast(dec))
    lines = lines.withColumn("discount_amount", F.when(F.col("sale_key") % 17 > 0, F.col("discount_amount")))
    return lines.select(*FACT_SALES.names, F.lit(1997).alias(SALE_YEAR))


def test_the_flat_views_lines_move_without_what_they_are_told_later(spark, staging, monkeypatch, unbroadcast):
    days = spark.sql("SELECT 19970203 date_key, DATE'1997-02-03' full_date, 1997 year, 1 quarter, 2 month, 'February' month_name, 3 day, 'Monday' weekday_name")
    customer = spark.range(1, 7).selectExpr("int(id) customer_key", "concat('c', id) customer_id", "repeat('n', 40) customer_name")
    product = spark.range(1, 6).selectExpr("int(id) product_key", "concat('p', id) product_name", "'Beauty' category")
    tables = {"fact_sales": odd_amounts(spark), "dim_date": days, "dim_customer": customer, "dim_product": product, "dim_region": spark.sql("SELECT 1 region_key, 'r' region_name")}
    wh = Warehouse({name: staging.write(table, name) for name, table in tables.items()})
    expected = sorted(map(tuple, analytics.sales_flat(wh).collect()))
    assert len(expected) == 78 and sum(None in row for row in expected) > 10
    monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", 150)
    large = analytics.sales_flat(wh)
    behind, *moved = [p for p in plan(large).split("Exchange hashpartitioning(")]
    joined = [line for line in plan(large).splitlines() if "SortMergeJoin" in line]
    assert ["product_key" in line for line in joined] == [False, True]  # the last join is printed first, and has the wider rows
    assert "month_name" in behind and not any("month_name" in text.partition("Scan parquet")[0] for text in moved)
    assert sorted(map(tuple, large.collect())) == expected
    assert sorted(map(tuple, analytics.sales_flat(wh, staging).collect())) == expected and "flat_lines-1" in staging.plans


def test_rows_places_need_no_pattern(spark, tmp_path):
    (tmp_path / "a b.txt").write_text("x\ny\n")
    rows = spark.read.text(f"file://{tmp_path}").select(block_place().alias("p")).select("p.path", "p.row")
    assert "regexp_replace" not in plan(rows)
    assert tuples(rows, "path", "row") == [(f"file:{tmp_path}/a%20b.txt", i) for i in range(2)]
