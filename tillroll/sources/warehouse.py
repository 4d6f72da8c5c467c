"""The star schema as Parquet. A load writes a new run; publishing it is one small file with the next number.

Readers see the last published run, so a refresh replaces everything at once (S6), and a load that
fails its checks or dies half-way is never seen. A run that adds lines to another (S5) holds the new rows only: its
name in the published file begins with the name of the run before, and readers take the tables of all its parts.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass, field
from functools import partial, reduce

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.lookup import HOT_KEYS, lookup, measured_bytes
from tillroll.operators.staging import COMPRESSION, delete_folder, plan_of, side_by_side
from tillroll.sources.schemas import WAREHOUSE_TABLES

# A published run is a file whose name is its number and whose text is the run; one without text counts for nothing.
_NUMBER = "[0-9]{12}"
# Tables beside the star: keys with at least 1/HOT_KEYS of the lines, and the monthly figures.
HOT_LINES, MONTHLY = "hot_keys", "monthly_kpis"
# What a further feed needs of those before: counts per price, medians by which outliers were told, hashes of the lines.
PROFILE, MEDIANS, LINE_HASHES = "price_profile", "category_medians", "line_hashes"
# Between the parts of a run's name, oldest first.
_ADDED = "+"
# A number without a name that is younger may get its name yet; an older one is that of a load that died.
_CLAIM_SECONDS = 60
_HOT_SCHEMA = "key_name string, key int, n_lines bigint"
# Distinct products that a filter of a row group is made for; with more it skips less.
_BLOOM = {"parquet.bloom.filter.enabled#product_key": "true", "parquet.bloom.filter.expected.ndv#product_key": "100000"}
# Partition column of the fact, so that a filter on the year of the sale skips files.
SALE_YEAR = "sale_year"


@dataclass
class Warehouse:
    """The five tables; sizes of dimensions are measured once, when a query first asks."""

    tables: dict[str, DataFrame]
    # Keys with very many lines, and monthly figures, where the run has them stored.
    hot_keys: DataFrame | None = None
    monthly: DataFrame | None = None
    _bytes: dict[str, int] = field(default_factory=dict)
    _rows: dict[str, int] = field(default_factory=dict)
    _dense: dict[str, int | None] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def size(self, name: str) -> int:
        if name not in self._bytes:
            self._bytes[name] = measured_bytes(self.tables[name])
        return self._bytes[name]

    def rows(self, name: str) -> int:
        if name not in self._rows:
            self._rows[name] = self.tables[name].count()
        return self._rows[name]

    def dense_keys(self, name: str, key: str) -> int | None:
        """n, if the keys of a dimension are exactly 1, 2, ..., n, so that a key is in it if it lies between; else None.

        Proven by a bitmap per 32,768 keys; reads the key column once.
        """
        if name not in self._dense:
            keys = self.tables[name].where(F.col(key).isNotNull())
            bounds = keys.agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).first()
            proven = None
            if bounds["n"] and bounds["low"] == 1 and bounds["high"] == bounds["n"]:
                sets = keys.groupBy(F.call_function("bitmap_bucket_number", F.col(key))).agg(
                    F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col(key))).alias("bits"))
                distinct = sets.agg(F.sum(F.call_function("bitmap_count", F.col("bits")))).first()[0]
                proven = bounds["n"] if distinct == bounds["n"] else None
            self._dense[name] = proven
        return self._dense[name]

    def attach(self, lines: DataFrame, name: str, key: str, columns: list[str]) -> DataFrame:
        """Inner join of lines to a dimension (J1-J6), row by row."""
        hot = self.hot_keys if self.hot_keys is None else self.hot_keys.where(F.col("key_name") == key).select(F.col("key").alias(key))
        return lookup(lines, self.tables[name].select(key, *columns), key, how="inner", hot=hot, table_bytes=self.size(name))


def table_schema(name: str) -> T.StructType:
    schema = WAREHOUSE_TABLES[name]
    if name == "fact_sales":
        return T.StructType([*schema.fields, T.StructField(SALE_YEAR, T.IntegerType())])
    return schema


def write_run(tables: dict[str, DataFrame], root: str, plans: dict[str, str] | None = None) -> str:
    """Write every table into a new run and return its name; ``plans`` gets the plan of each write."""
    run = uuid.uuid4().hex

    def write(name: str) -> None:
        path, table = f"{root}/runs/{run}/{name}", tables[name]
        if name == "fact_sales":
            # The clean lines come in files of few years each, so no shuffle is needed for files of a good size. In order of
            # customers within a file, its pages and row groups are skipped by their least and greatest key; products by Bloom filters.
            table = table.withColumn(SALE_YEAR, F.expr("date_key div 10000").cast("int"))
            table = table.sortWithinPartitions(SALE_YEAR, "customer_key")
        if plans is not None:
            plans[name] = plan_of(table)
        writer = table.write.partitionBy(SALE_YEAR).options(**_BLOOM) if name == "fact_sales" else table.write
        writer.option("compression", COMPRESSION).parquet(path)

    side_by_side(tables["fact_sales"].sparkSession, *[partial(write, name) for name in tables])
    return run


def hot_keys(counts: dict[str, DataFrame]) -> DataFrame:
    """(key_name, key, n_lines) of the keys with at least 1/HOT_KEYS of the lines, from (key, n_lines) per key name."""
    parts = [
        table.select(F.lit(name).alias("key_name"), F.col(name).cast("int").alias("key"), F.col("n_lines").cast("long").alias("n_lines"))
        for name, table in counts.items()
    ]
    every = reduce(DataFrame.unionByName, parts)
    totals = every.groupBy("key_name").agg(F.sum("n_lines").alias("all_lines"))
    return every.join(F.broadcast(totals), "key_name").where(F.col("n_lines") * HOT_KEYS >= F.col("all_lines")).drop("all_lines")


def add_to_run(table: DataFrame, root: str, run: str, name: str) -> None:
    """A further table of a run that isn't published yet."""
    table.write.parquet(f"{root}/runs/{run}/{name}")


def read_run(spark: SparkSession, root: str, run: str, extras: bool = True) -> Warehouse:
    """The tables of a run; ``extras`` with what is stored beside the star."""
    folders = run_folders(root, run)

    def whole(name: str, schema: T.StructType | str) -> DataFrame:
        # A scan per part, since each has its own partition folders.
        return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(f"{folder}/{name}") for folder in folders])

    tables = {name: whole(name, table_schema(name)) for name in WAREHOUSE_TABLES}
    if not extras:
        return Warehouse(tables)
    hot = whole(HOT_LINES, _HOT_SCHEMA)
    if len(folders) > 1:
        # A key with a 2000th of all lines has one in some part, so none is missed; its count in other parts may be.
        hot = hot.groupBy("key_name", "key").agg(F.sum("n_lines").alias("n_lines"))
    return Warehouse(tables, hot, spark.read.parquet(f"{folders[-1]}/{MONTHLY}"))


def run_folders(root: str, run: str) -> list[str]:
    """The folders of a run's parts, oldest first."""
    return [f"{root}/runs/{part}" for part in run.split(_ADDED)]


def added_to(base: str, part: str) -> str:
    """The name of the run that has the rows of ``base`` and those of ``part``."""
    return f"{base}{_ADDED}{part}"


def stored_parts(spark: SparkSession, root: str, run: str, name: str) -> list[DataFrame]:
    """A table that is stored beside the star, of each part of the run."""
    return [spark.read.parquet(f"{folder}/{name}") for folder in run_folders(root, run)]


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The path and its file system, as the path names it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _published(spark: SparkSession, root: str) -> DataFrame:
    """(number, run, published_at); empty before the first publication."""
    folder, files = _files(spark, f"{root}/published")
    if not files.exists(folder):
        return spark.createDataFrame([], "number bigint, run string, published_at timestamp")
    name = F.regexp_extract("_metadata.file_name", f"^({_NUMBER})$", 1)
    return spark.read.text(f"{root}/published").where((name != "") & (F.length("value") > 0)).select(
        name.cast("bigint").alias("number"), F.col("value").alias("run"), F.col("_metadata.file_modification_time").alias("published_at"))


def _claim(spark: SparkSession, path: str, run: str) -> bool:
    """Create the file with the run's name in it, unless there is one; whether it is this run's in the end.

    As atomic as the file system's creation without overwriting, which its reading back backs up. Hadoop's local file system
    looks for the file first and creates it then, so there (shared mounts included) the operating system creates it.
    """
    target, files = _files(spark, path)
    local = files.getUri().getScheme() == "file"
    if local:
        files.mkdirs(target.getParent())
        if not spark._jvm.java.io.File(files.makeQualified(target).toUri()).createNewFile():
            return False
    try:
        out = files.create(target, local)
    except Py4JJavaError as taken:
        if files.exists(target):
            return False
        raise taken
    out.write(run.encode())
    out.close()
    read = files.open(target)
    text = bytes(read.readNBytes(len(run)))
    read.close()
    return text == run.encode()


def publish(spark: SparkSession, root: str, run: str, after: int | None = None) -> int | None:
    """The run gets the next number that nobody has; readers follow the highest. No clock decides which is the last.

    Loads that end at once go for the same number, and all but one go on to the next. A load that dies between taking a
    number and writing its name leaves a number that means nothing. A run that adds to the one published as ``after`` must
    be the next after it: where anything else took a number since, this returns None, and nothing is published.
    """
    folder, files = _files(spark, f"{root}/published")
    claims = list(files.listStatus(folder)) if files.exists(folder) else []
    claims = {int(s.getPath().getName()): s for s in claims if re.fullmatch(_NUMBER, s.getPath().getName())}
    number = 1 + max(claims, default=0)
    if after is not None:
        oldest = (time.time() - _CLAIM_SECONDS) * 1000
        if any(n > after and (s.getLen() > 0 or s.getModificationTime() > oldest) for n, s in claims.items()):
            return None
        return number if _claim(spark, f"{root}/published/{number:012}", run) else None
    while not _claim(spark, f"{root}/published/{number:012}", run):
        number += 1
    return number


def published_run(spark: SparkSession, root: str) -> str:
    return last_published(spark, root)[1]


def last_published(spark: SparkSession, root: str) -> tuple[int | None, str | None]:
    """Number and run; (None, None) before the first publication."""
    return tuple(_published(spark, root).agg(F.max("number"), F.max_by("run", "number")).first())


def read_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """The last published run."""
    return read_run(spark, root, published_run(spark, root))


def discard_run(spark: SparkSession, root: str, run: str) -> None:
    """Delete what the run itself wrote; the runs it adds to stay."""
    delete_folder(spark, run_folders(root, run)[-1])


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all runs but the last ``keep`` published ones; not while a load is under way. Returns what is gone."""
    rows = _published(spark, root).orderBy(F.desc("number")).limit(max(1, keep)).collect()
    kept = {part for r in rows for part in r["run"].split(_ADDED)}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/runs")
    names = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    gone = [name for name in names if name not in kept]
    for name in gone:
        discard_run(spark, root, name)
    return gone
