import pytest
from helpers import tuples
from pyspark.sql import functions as F

from tillroll.operators.ordering import freeze_in_order, number_rows
from tillroll.sources.feed import read_feed, with_nulls, write_csv
from tillroll.sources.schemas import ORDINAL, RAW_COLUMNS

HEADER = ",".join(RAW_COLUMNS)


def line(order_id, name="Ann", product="Mat"):
    return f"{order_id},2024-06-01,C1,{name},North,{product},Sports,1,2.00,0,UPI,Online"


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_quotes_line_breaks_and_nulls(spark, tmp_path):
    path = write(
        tmp_path / "feed.csv", HEADER, line("O1", '"Lee, ""Ann"""', '"Yoga\nMat"'), line("O2", '""'), line("O3", " NA "),
        line("O4", "NA"),
    )
    raw = with_nulls(read_feed(spark, path)).orderBy(ORDINAL)
    assert tuples(raw, "order_id", "customer_name", "product_name") == [
        ("O1", 'Lee, "Ann"', "Yoga\nMat"), ("O2", None, "Mat"), ("O3", " NA ", "Mat"), ("O4", None, "Mat"),
    ]
    assert all(f.dataType.simpleString() == "string" for f in raw.schema if f.name in RAW_COLUMNS)


def test_columns_are_bound_by_name(spark, tmp_path):
    path = write(tmp_path / "feed.csv", "extra," + ",".join(reversed(RAW_COLUMNS)), "x," + ",".join(reversed(line("O1").split(","))))
    assert tuples(read_feed(spark, path), *RAW_COLUMNS) == [tuple(line("O1").split(","))]


def test_a_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path / "feed.csv", "order_id,order_date", "O1,2024-06-01")
    with pytest.raises(ValueError, match="customer_id"):
        read_feed(spark, path)


def test_an_overlong_line_ends_the_job_and_a_short_one_is_filled_up(spark, tmp_path):
    short = write(tmp_path / "short.csv", HEADER, line("O1"), "O2,2024-06-01", line("O3", '"Lee, Ann"'))
    assert tuples(read_feed(spark, short).orderBy(ORDINAL), "order_id", "customer_name") == [("O1", "Ann"), ("O2", None), ("O3", "Lee, Ann")]
    for extra in (line("O2", product="Mat, red"), line("O2") + ",", line("O2", '"a, b"', "x, y")):
        path = write(tmp_path / "long.csv", HEADER, line("O1"), extra)
        with pytest.raises(Exception, match="more than 12 fields"):
            read_feed(spark, path).collect()


def test_a_break_in_one_of_many_files_is_found(spark, tmp_path):
    for i in range(5):
        write(tmp_path / "in" / f"f {i}%.csv", HEADER, line(f"O{i}", product='"Yoga\nMat"' if i == 3 else "Mat"))
    raw = read_feed(spark, str(tmp_path / "in")).orderBy(ORDINAL)
    assert tuples(raw, "order_id", "product_name") == [(f"O{i}", "Yoga\nMat" if i == 3 else "Mat") for i in range(5)]


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    path = write(tmp_path / "feed.csv", HEADER, *[line(f"O{i}") for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert read_feed(spark, path).select(F.spark_partition_id()).distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("multi_line", [True, False, None])
def test_order_runs_through_files_and_splits(spark, staging, tmp_path, multi_line):
    # The last file by name is the largest, which Spark would read first.
    orders = [f"O{i}" for i in range(3000)]
    for name, part in {"a": orders[:10], "b c": orders[10:60], "d": orders[60:]}.items():
        write(tmp_path / "in" / f"{name}.csv", HEADER, *map(line, part))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        raw = read_feed(spark, str(tmp_path / "in"), multi_line)
        numbered = number_rows(freeze_in_order(raw, [ORDINAL], staging, "feed"), "n")
        assert tuples(numbered.orderBy("n"), "n", "order_id") == [(i + 1, o) for i, o in enumerate(orders)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_written_text_reads_back_unchanged(spark, tmp_path):
    values = [" padded ", 'quote " inside', "comma, inside", "back\\slash", "line\nbreak", "NA"]
    df = spark.createDataFrame([(v, str(i)) for i, v in enumerate(values)], "v string, i string").coalesce(1)
    write_csv(df, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True, escape='"', multiLine=True)
    assert tuples(back.orderBy(F.col("i").cast("int")), "v") == [(v,) for v in values]
