import random
import statistics

import pytest
from helpers import tuples
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import positions
from tillroll.operators.firsts import first_positions, first_values
from tillroll.operators.lookup import lookup, measured_bytes
from tillroll.operators.medians import group_medians
from tillroll.operators.ordering import freeze_in_order, number_rows, rank_descending
from tillroll.operators.positions import keep_numbered, position_sets, with_positions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [1, 32])
def test_numbers_are_dense_and_in_order(spark, staging, partitions):
    rows = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("position")).repartition(partitions)
    numbered = number_rows(freeze_in_order(rows, ["position"], staging, "rows"), "n")
    assert sorted(tuples(numbered, "position", "n")) == [(i, i + 1) for i in range(5000)]


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_rank_shares_the_first_number_among_ties_and_ranks_nulls_last(spark, staging, monkeypatch, broadcast_bytes):
    if broadcast_bytes is not None:
        monkeypatch.setattr("tillroll.operators.lookup.BROADCAST_BYTES", broadcast_bytes)
    scores = [5, 3, 5, 1, 3, 3, 0, 9, None, None, *[7] * 6]  # one value has a third of the rows
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, score int").repartition(3)
    ranked = rank_descending(df, "score", "r", staging, "scores")
    window = df.withColumn("r", F.rank().over(Window.orderBy(F.col("score").desc())))
    assert sorted(tuples(ranked, "i", "r")) == sorted(tuples(window, "i", "r"))


@pytest.mark.parametrize("partitions", [1, 16])
def test_medians_over_multiplicities(spark, staging, partitions):
    rng = random.Random(5)
    groups = {"hot": 3000, "odd": 101, "even": 50, "one": 1, "two": 2, None: 20}
    # Many distinct values in the hot group, so that its ranks lie across range partitions.
    values = {g: [float(rng.randint(1, 10 * n)) for _ in range(n)] for g, n in groups.items()}
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("hot", None)] * 5 + [("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(partitions)
    counts = df.groupBy("g", "v").agg(F.count("v").alias("n"))
    frozen = freeze_in_order(counts.repartition(8), ["g", "v"], staging, "values")
    got = {g: (m, n) for g, m, n in tuples(group_medians(frozen, "g", "v", "n"), "g", "median", "n_values")}
    assert got == {g: (statistics.median(vs), len(vs)) for g, vs in values.items() if g is not None}


def test_median_across_two_range_partitions(spark, staging):
    df = spark.range(1, 1001).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frozen = freeze_in_order(df, ["g", "v"], staging, "values")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert frozen.select(F.shiftright("slot", 33)).distinct().count() > 1
    assert tuples(group_medians(frozen, "g", "v", "n"), "median", "n_values") == [(500.5, 1000)]


@pytest.fixture
def small_sets(monkeypatch):
    """Chunks of 64 positions in groups of two, so that a few rows make many."""
    monkeypatch.setattr(positions, "CHUNK_BITS", 6)
    monkeypatch.setattr(positions, "_GROUP_BITS", 1)


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_sets_keep_and_number_rows(spark, staging, monkeypatch, small_sets, broadcast_bytes):
    if broadcast_bytes is not None:
        monkeypatch.setattr(positions, "BROADCAST_BYTES", broadcast_bytes)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = spark.range(1000).select(F.col("id").alias("position"), (F.col("id") * 7).alias("v")).repartition(5)
    chosen = {i for i in range(1000) if i % 7 in (0, 3) and not 128 <= i < 400}
    sets = position_sets(rows.where(F.col("position").isin(list(chosen))).select("position"), staging, "chosen")
    got = keep_numbered(rows, sets, "n")
    assert sorted(tuples(got, "position", "v", "n")) == [(p, p * 7, i) for i, p in enumerate(sorted(chosen), 1)]
    assert tuples(sets.agg(F.sum("n").alias("n")), "n") == [(len(chosen),)]
    try:
        assert plan(got).count("Exchange hashpartitioning(position_chunk") == (1 if broadcast_bytes is None else 2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert keep_numbered(rows, position_sets(rows.limit(0).select("position"), staging, "none"), "n").count() == 0


def keyed_rows(spark):
    rows = [("a", None, 3, "late"), ("a", None, 1, "early"), ("b", 1, 2, "only"), (None, None, 9, "x"), (None, None, 8, "y"), ("b", 2, 70, "other")]
    rows += [("hot", 5, 100 + i, f"h{i}") for i in range(400)]
    return spark.createDataFrame(rows, "k string, l int, position bigint, v string").repartition(4)


@pytest.mark.parametrize("same_hash", [False, True])
def test_first_rows_by_key_whatever_the_hash(spark, staging, monkeypatch, small_sets, same_hash):
    if same_hash:  # every row has the hash of every other
        monkeypatch.setattr("tillroll.operators.firsts.F.xxhash64", lambda *columns: F.lit(7).cast("bigint"))
    rows = keyed_rows(spark)
    got = keep_numbered(rows, first_positions(rows, ["k", "l"], staging, "firsts"), "n")
    assert sorted(tuples(got, "n", "v")) == [(1, "early"), (2, "only"), (3, "y"), (4, "other"), (5, "h0")]


def test_only_hashes_and_positions_are_shuffled_for_first_rows(spark, staging):
    first_positions(keyed_rows(spark), ["k", "l"], staging, "firsts")
    before = staging.plans["firsts-hashes"].partition("Exchange hashpartitioning(_h1")[2]
    assert "partial_min(position" in before.split("\n")[1] and "v#" not in before.split("\n")[1]


def block_rows(spark, counts, gap=0):
    """Rows of files (path, block): running numbers as a scan gives them, where small files share a task."""
    rows = [(path, block, (i << 33) + k * (1 + gap)) for i, (path, block, n) in enumerate(counts) for k in range(n)]
    frame = spark.createDataFrame([(*r, f"{r[0]}:{r[1]}:{r[2]}") for r in rows], "path string, block bigint, row bigint, v string")
    return frame.select(F.struct("path", "block", "row").alias("at"), "v"), [f"{p}:{b}:{r}" for p, b, r in sorted(rows)]


@pytest.mark.parametrize("gap", [0, 2])
def test_positions_follow_files_and_blocks(spark, staging, gap):
    counts = [("b", 128, 5), ("a", 0, 7), ("b", 0, 9), ("c", 0, 1), ("a", 64, 3)]
    rows, expected = block_rows(spark, counts, gap)
    got = sorted(tuples(with_positions(rows.repartition(4), "at", staging), "position", "v"))
    assert [v for _, v in got] == expected and len({p for p, _ in got}) == len(got)
    assert gap or [p for p, _ in got] == list(range(len(got)))


def test_positions_of_other_orders(spark, staging):
    rows = spark.range(500).select(F.struct((F.col("id") % 5).alias("a"), "id").alias("o"), "id").repartition(3)
    got = tuples(with_positions(rows, "o", staging).orderBy("position"), "position", "id")
    assert got == [(i, x) for i, x in enumerate(sorted(range(500), key=lambda x: (x % 5, x)))]


def test_first_values_keep_nulls_and_count(spark, staging):
    rows = [("a", 2, "x"), ("a", 1, None), ("b", 3, "y")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = first_values(df, "k", ["v"], "o", staging)
    assert "SortAggregate" not in staging.plans["firsts_k"] and "HashAggregate" in staging.plans["firsts_k"]
    assert sorted(tuples(got, "k", "v", "first_line", "n_lines")) == [("a", None, 1, 2), ("b", "y", 3, 1)]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the lines on one key, a third on null keys, some keys unknown to the table."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 70))
    lines = spark.range(3000).select("id", key.alias("k")).repartition(8)
    names = ["hot", *[f"k{i}" for i in range(50)]]
    table = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "k string, payload int")
    counts = lines.groupBy("k").agg(F.count("*").alias("n"))
    return lines, table, table.join(counts, "k", "left").fillna(0, ["n"])


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("weighted", ["weight", "hot", ""])
def test_lookup_beyond_the_broadcast_bound_gives_the_same(skewed, how, weighted):
    lines, table, with_counts = skewed
    expected = sorted(tuples(lines.join(table, "k", how), "id", "k", "payload"), key=str)
    small = lookup(lines, table, "k", how)
    assert "BroadcastHashJoin" in plan(small)
    known = {"weight": {"weight": "n"}, "hot": {"hot": with_counts.where("n > 300")}, "": {}}[weighted]
    large = lookup(lines, with_counts if weighted == "weight" else table, "k", how, broadcast_bytes=0, hot_keys=10, **known)
    assert small.columns == large.columns == ["id", "k", "payload"]
    assert sorted(tuples(small, "id", "k", "payload"), key=str) == expected
    assert sorted(tuples(large, "id", "k", "payload"), key=str) == expected


def test_lookup_spreads_hot_and_null_keys(spark, skewed):
    lines, _, with_counts = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup(lines, with_counts, "k", "left", "n", broadcast_bytes=0, hot_keys=10)
        assert "hashpartitioning(_cold_key" in plan(joined) and "_slice" in plan(joined)
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) < 2 * 3000 / 4


def test_measured_bytes_counts_text(spark):
    df = spark.createDataFrame([("x" * 1000,), (None,)], "s string")
    assert 1000 <= measured_bytes(df) <= 1100
    assert measured_bytes(df.limit(0)) == 0
