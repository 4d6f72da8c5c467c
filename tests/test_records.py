"""Feeds with quoted line breaks, read in parallel, against Spark's own parser, which reads a file in one task."""

import random

import pytest
from pyspark.sql import functions as F

from tillroll.operators import positions
from tillroll.sources import records
from tillroll.sources.feed import read_feed
from tillroll.sources.schemas import ORDINAL, RAW_COLUMNS

HEADER = ",".join(RAW_COLUMNS)
VALUES = [
    "a", "", '""', '"q"', '"x\ny"', '"x\n\n\nlong, one\ny"', '"a""b"', '"""\n"""', '5" pipe', '"\n,"', ' "4"', '"x" ', '"tail""\n"', "é\U0001F600",
    '"x"y', '","', '"\n"', "o'k", '"' + "\n" * 40 + '"',
]


def random_file(rng, n, end="\n"):
    lines = [",".join([str(i), *[rng.choice(VALUES) for _ in range(rng.choice([11, 11, 11, 7]))]]) for i in range(n)]
    for _ in range(n // 20):
        lines.insert(rng.randint(0, len(lines)), "")
    return end.join([HEADER, *lines, ""])


@pytest.fixture
def small(spark, monkeypatch):
    """Chunks of 32 lines, two in a group, and splits of 2 KB."""
    monkeypatch.setattr(positions, "CHUNK_BITS", 5)
    monkeypatch.setattr(positions, "_GROUP_BITS", 1)
    settings = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "256"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def by_spark(spark, path):
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    rows = spark.read.csv(path, schema=schema, header=True, escape='"', multiLine=True).select("*", F.col("_metadata.file_path").alias("p"))
    place = F.struct("p", F.monotonically_increasing_id().alias("i"))
    return [tuple(r) for r in rows.withColumn("i", place).orderBy("i").select(*RAW_COLUMNS).collect()]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_as_spark_reads_it(spark, staging, small, tmp_path, end):
    rng = random.Random(7)
    for i in range(4):
        text = random_file(rng, [300, 1, 0, 150][i])
        (tmp_path / f"f{i}.csv").write_bytes(text.replace("\n", end).encode())
    (tmp_path / "f4.csv").write_bytes(b"\xef\xbb\xbf" + random_file(rng, 40).replace("\n", end).encode())
    got = read_feed(spark, str(tmp_path), staging=staging)
    assert [tuple(r)[:-1] for r in got.orderBy(ORDINAL).collect()] == by_spark(spark, str(tmp_path))
    assert got.select(ORDINAL).distinct().count() == got.count()


def test_one_file_is_read_by_several_tasks(spark, staging, small, tmp_path):
    (tmp_path / "feed.csv").write_text(random_file(random.Random(3), 600), encoding="utf-8")
    read_feed(spark, str(tmp_path / "feed.csv"), staging=staging)
    lines = spark.read.parquet(f"{staging.folder}/lines")
    blocks = [r.n for r in lines.groupBy("place.block").agg(F.count("*").alias("n")).collect()]
    assert len(blocks) > 8 and max(blocks) < sum(blocks) / 4


def test_broken_records_alone_are_shuffled(spark, staging, small, tmp_path):
    (tmp_path / "feed.csv").write_text(random_file(random.Random(3), 200), encoding="utf-8")
    rows = records.read_records(spark, str(tmp_path / "feed.csv"), staging).rows
    whole, _, broken = rows._jdf.queryExecution().executedPlan().toString().partition("collect_list")
    assert "Exchange hashpartitioning(record" in broken and "CartesianProduct" not in whole + broken
    assert "Python" not in whole + broken


def test_an_unclosed_quote_ends_with_its_file(spark, staging, small, tmp_path):
    rest = ",2024-06-01,C1,Ann,North,Mat,Sports,1,2.00,0,UPI,Online\n"
    (tmp_path / "a.csv").write_text(HEADER + "\nO1" + rest + 'O2,"open' + "\nO3 goes on" * 100)
    (tmp_path / "b.csv").write_text(HEADER + "\nO4" + rest + 'O5,"x\ny"' + rest[11:])
    got = read_feed(spark, str(tmp_path), staging=staging).orderBy(ORDINAL).select("order_id", "order_date").collect()
    assert [r.order_id for r in got] == ["O1", "O2", "O4", "O5"] and got[1].order_date.count("O3") == 100 and got[3].order_date == "x\ny"


def test_a_differing_header_ends_the_job(spark, staging, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + '\nO1,"x\ny",,,,,,,,,,\n')
    (tmp_path / "b.csv").write_text(HEADER.replace("region", "area") + "\nO2,,,,,,,,,,,\n")
    with pytest.raises(Exception, match="header differs"):
        read_feed(spark, str(tmp_path), staging=staging).collect()


def test_files_cut_at_carriage_returns_are_read_whole(spark, staging, tmp_path):
    text = HEADER + '\nO1,"x\ny",,,,,,,,,,\nO2,,,,,,,,,,,\n'
    (tmp_path / "a.csv").write_bytes(text.replace("\n", "\r").encode())
    got = read_feed(spark, str(tmp_path), multi_line=True, staging=staging).orderBy(ORDINAL).collect()
    assert [r.order_id for r in got] == ["O1", "O2"]


@pytest.mark.parametrize(("line", "outside", "inside"), [
    ("a,b", False, True), ('a,"b', True, False), ('b",c', False, False), ('b"', False, False), ('"a","b"', False, False), ('5" pipe', False, False),
    ('5" pipe,"z', True, True), ('"x"y,"z', True, True), ('"a""', True, False), ('x"","y', True, False), ("", False, True), ('",', True, False),
])
def test_what_a_line_does_to_the_state(spark, line, outside, inside):
    row = spark.createDataFrame([(line,)], "l string").select(records.ends_inside(F.col("l")), records.stays_inside(F.col("l"))).first()
    assert tuple(row) == (outside, inside)
