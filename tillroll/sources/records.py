"""S1 and S3 where quoted values go on over line breaks: physical lines, read in parallel, put together to records.

Whether a line begins inside a quoted value depends on all lines before it in its file. A line with quotes maps the state it
begins in to the state it ends in; the states of all lines follow from two running totals: how many lines so far turn the
state over, and the last line that ends in one state whatever it began in. Only such lines, as numbers, go through that. Lines
that are records of their own are parsed where they are read; just those of broken records are brought together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.operators import positions
from tillroll.operators.positions import CHUNK, POSITION, block_place, bounded_broadcast, chunk_of_position, in_set, position_sets, running, with_positions
from tillroll.operators.staging import Staging

_PLACE = "place"
# Behind the closing quote all belongs to the field, up to the next comma. Doubled quotes are taken out before, so that the
# expression needs no alternatives, which would cost the JVM stack for every one of them.
_REST = '[^"]*+"[^,]*+'


def _without_pairs(line: Column) -> Column:
    return F.replace(line, F.lit('""'), F.lit(""))


def _opens(line: Column) -> Column:
    """A quoted value opens at the begin of a field only."""
    return F.regexp_replace(line, f'(^|,)"{_REST}', "$1").rlike('(^|,)"')


def ends_inside(line: Column) -> Column:
    """Whether a quoted value is open behind a line that begins outside of one."""
    return _opens(_without_pairs(line))


def stays_inside(line: Column) -> Column:
    """The same for a line that begins inside of a quoted value."""
    line = _without_pairs(line)
    return ~line.contains('"') | _opens(F.regexp_replace(line, f"^{_REST}", ""))


def has_open_quotes(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether any line ends inside of a quoted value; one pass over the text, which ends at the first such line."""
    lines = spark.read.text(path).where(F.col("value").contains('"'))
    return not lines.where(ends_inside(F.col("value"))).limit(1).isEmpty()


@dataclass
class Records:
    """Records of the text files as (place, value), in the order of ``place``, those of headers marked by ``is_header``."""

    rows: DataFrame
    # Files whose lines end with a carriage return alone, which only a parser that reads them whole can cut.
    n_odd_files: int


def read_records(spark: SparkSession, path: str | list[str], staging: Staging) -> Records:
    raw = spark.read.text(path, lineSep="\n").select(F.regexp_replace("value", "^\\uFEFF", "").alias("value"), block_place().alias(_PLACE))
    lines = with_positions(staging.write(raw, "lines"), _PLACE, staging, "line_blocks")
    # The first line of a file that is not blank is its header, and tells how the file's lines end.
    text = F.rtrim(F.col("value"), F.lit("\r"))
    blank = text == ""
    heads = lines.where(~blank).groupBy(F.col(f"{_PLACE}.path").alias("head_path")).agg(
        F.min(POSITION).alias("head"), F.min_by("value", POSITION).alias("head_line"))
    heads = staging.write(heads.select(
        "head_path", "head", F.col("head_line").endswith("\r").alias("crlf"), F.rtrim("head_line", F.lit("\r")).contains("\r").alias("odd")), "heads")
    broken = _broken_lines(lines, staging)

    ended = lines.join(bounded_broadcast(heads.select("head_path", "head", "crlf")), F.col(f"{_PLACE}.path") == F.col("head_path"))
    ended = ended.withColumn("value", F.when(F.col("crlf"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")))
    sets = bounded_broadcast(position_sets(broken.select(POSITION), staging, "broken_sets").select(CHUNK, "bits"))
    marked = ended.withColumn(CHUNK, chunk_of_position()).join(sets, CHUNK, "left")
    is_broken = F.coalesce(in_set(F.col("bits")), F.lit(False))
    is_header = (F.col(POSITION) == F.col("head")).alias("is_header")
    whole = marked.where(~is_broken).where(F.col("value") != "").select(_PLACE, "value", is_header)
    parts = marked.where(is_broken).select(POSITION, _PLACE, "value", "head").join(broken, POSITION)
    joined = parts.groupBy("record", "head").agg(
        F.min_by(_PLACE, POSITION).alias(_PLACE), F.array_sort(F.collect_list(F.struct(POSITION, "value"))).alias("lines"))
    joined = joined.select(_PLACE, F.array_join("lines.value", "\n").alias("value"), (F.col("record") == F.col("head")).alias("is_header"))
    return Records(whole.unionByName(joined), heads.where("odd").count())


def _broken_lines(lines: DataFrame, staging: Staging) -> DataFrame:
    """(POSITION, record) of the lines of records that go over several; ``record`` is the position of their first line."""
    chunk_size = 1 << positions.CHUNK_BITS
    firsts = lines.groupBy(F.col(f"{_PLACE}.path").alias("first_path")).agg(F.min(POSITION).alias("first"))
    firsts = bounded_broadcast(staging.write(firsts, "file_firsts"))
    # Lines without quotes leave the state as it is; the first ones of files and chunks are looked at all the same.
    quoted, opens = F.col("value").contains('"'), F.col(POSITION) == F.col("first")
    told = lines.join(firsts, F.col(f"{_PLACE}.path") == F.col("first_path")).where(quoted | opens | (F.col(POSITION) % chunk_size == 0))
    f0 = F.when(quoted, ends_inside(F.col("value"))).otherwise(False).cast("bigint")
    # A line that opens a file ends as it does from outside, whatever the file before ended in.
    f1 = F.when(opens, f0).when(quoted, stays_inside(F.col("value")).cast("bigint")).otherwise(1)
    told = staging.write(told.select(POSITION, chunk_of_position().alias(CHUNK), opens.alias("opens"), f0.alias("f0"), f1.alias("f1")), "told")

    turn = F.when((F.col("f0") == 1) & (F.col("f1") == 0), 1).otherwise(0).cast("bigint")
    told = running(told, turn, F.sum, "turns", staging)
    # Where the state is known for sure: with it, the position, and the state as it would be had no line turned it before.
    known = F.when(F.col("f0") == F.col("f1"), F.col(POSITION) * 2 + F.col("f0").bitwiseXOR(F.col("turns").bitwiseAND(F.lit(1))))
    told = running(told, known, F.max, "known", staging, itself=False)
    state = F.col("known").bitwiseXOR(F.col("turns") - turn).bitwiseAND(F.lit(1))
    told = told.withColumn("before", F.when(F.col("opens"), 0).otherwise(state))
    told = told.withColumn("after", F.when(F.col("before") == 0, F.col("f0")).otherwise(F.col("f1")))
    begins = F.when((F.col("before") == 0) & (F.col("after") == 1), F.col(POSITION))
    told = running(told, begins, F.max, "record", staging)
    following = F.lead(POSITION).over(Window.partitionBy(CHUNK).orderBy(POSITION))
    upto = F.coalesce(following, (F.col(CHUNK) + 1) * chunk_size) - 1
    going_on = told.withColumn("upto", upto).where("after = 1").select("record", F.explode(F.sequence(POSITION, F.col("upto"))).alias(POSITION))
    ending = told.where("before = 1 AND after = 0").select("record", POSITION)
    return staging.write(going_on.unionByName(ending), "broken")
