"""Dense numbering and ranking in a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.lookup import lookup
from tillroll.operators.staging import Staging

# Where a frozen row sits: range partition in the upper bits, place inside it in the lower 33.
SLOT = "slot"
_PLACE_BITS = 33


def chunk_of(slot: Column) -> Column:
    """The range partition a frozen row was written by."""
    return F.shiftright(slot, _PLACE_BITS)


def freeze_in_order(df: DataFrame, order: list[str], staging: Staging, name: str) -> DataFrame:
    """Range-partition and sort by ``order``, which must be unique per row, and write with a ``slot``.

    Unique order values keep the ranges balanced whatever the data looks like, and make each range's
    content the same when a lost task runs again. Once written, the positions cannot move.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return staging.write(ranged.withColumn(SLOT, F.monotonically_increasing_id()), name)


def number_rows(frozen: DataFrame, number: str) -> DataFrame:
    """Add ``number`` = 1, 2, 3, ... in the frozen order and drop the slot; no shuffle of the rows.

    Only one row per range partition goes through the running total and is broadcast, so both are
    bounded by the number of write tasks, not by the data.
    """
    sizes = frozen.groupBy(chunk_of(F.col(SLOT)).alias("chunk")).agg(F.count("*").alias("n"))
    return place_rows(frozen, running_offsets(sizes, "n"), number)


def running_offsets(sizes: DataFrame, n: str) -> DataFrame:
    """Per range partition, how much comes before it."""
    return sizes.select("chunk", (F.sum(n).over(Window.orderBy("chunk")) - F.col(n)).alias("before"))


def place_rows(frozen: DataFrame, offsets: DataFrame, number: str) -> DataFrame:
    place = F.col(SLOT).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        frozen.join(F.broadcast(offsets), chunk_of(F.col(SLOT)) == F.col("chunk"))
        .withColumn(number, F.col("before") + place + 1)
        .drop(SLOT, "chunk", "before")
    )


def rank_descending(df: DataFrame, by: str, rank: str, staging: Staging, name: str) -> DataFrame:
    """RANK() OVER (ORDER BY by DESC) for any number of rows: ties share the first of their numbers, nulls come last.

    Rows are first reduced to distinct values with a count, so a value that many rows share is one row; ranks are
    looked up by value, with values that very many rows share spread over all tasks. ``df`` is read twice.
    """
    values = df.groupBy(by).agg(F.count("*").alias("n"))
    values = values.withColumn("missing", F.col(by).isNull()).withColumn("descending", -F.col(by))
    frozen = freeze_in_order(values, ["missing", "descending"], staging, name)
    totals = frozen.groupBy(chunk_of(F.col(SLOT)).alias("chunk")).agg(F.sum("n").alias("chunk_n"))
    offsets = running_offsets(totals, "chunk_n")
    placed = frozen.withColumn("chunk", chunk_of(F.col(SLOT))).join(F.broadcast(offsets), "chunk")
    inside = F.sum("n").over(Window.partitionBy("chunk").orderBy(SLOT)) - F.col("n")
    ranks = staging.write(placed.select(by, (F.col("before") + inside + 1).alias(rank), "n"), f"{name}_ranks")
    # Rows without a value find none; they share the rank behind all values.
    last = frozen.where(~F.col("missing")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1
    ranked = lookup(df, ranks.where(F.col(by).isNotNull()), by, weight="n")
    return ranked.withColumn(rank, F.coalesce(rank, F.lit(last)))
