"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1. Its integral is the source's cumulative demand for tokens;
a document that fills the source's tokens from c to c + size stands where the demand reaches the middle of that span,
so inverting the demand gives it its training position. Sorting all sources' documents by position, in ranges, mixes
them at every moment in the proportions of the schedules. Only DataFrame operations are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.words import fresh
from tillroll.operators.ordering import freeze_in_order, number_rows
from tillroll.operators.staging import Staging

WEIGHTS = (3, 1, 2)
# Change of a source's weight over training, by place in WEIGHTS: it falls from 1 + tilt to 1 - tilt times its mean.
TILTS = (0.5, 0.0, -0.5)
BUDGET = 1.5
MOST_REPEATS = 2
# Rows of one source whose running total is formed together, about.
BUCKET_ROWS = 2_000


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def demand_position(share: Column, tilt: Column) -> Column:
    """Time at which a source has given ``share`` of its tokens, where its weight is 1 + tilt - 2 tilt t times the mean.

    The integral is (1 + tilt) t - tilt t^2; this is its inverse, in the form that stays exact for small tilts.
    """
    start = 1 + tilt
    return 2 * share / (start + F.sqrt(F.greatest(F.lit(0.0), start * start - 4 * tilt * share)))


@dataclass
class Mix:
    """``sources``: source, size, place, weight, tilt, target; one row per source, null included."""

    sources: DataFrame


def targets(sizes: DataFrame, staging: Staging, weights: tuple[int, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS, budget: float = BUDGET, most: int = MOST_REPEATS) -> Mix:
    """Targets of sources from (source, size) rows: weights go round by code point order, null last.

    All targets share ``budget`` times the total size by weight; a target above ``most`` times its source's size stops
    there, and the excess is shared again among the others, until none is above.
    """
    frozen = freeze_in_order(sizes.withColumn("missing", F.col("source").isNull()), ["missing", "source"], staging, "sources")
    turn = ((F.col("place") - 1) % len(weights)).cast("int")
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), turn)
    placed = number_rows(frozen, "place").select("source", "size", "place", pick(weights).alias("weight"), pick([float(t) for t in tilts]).alias("tilt"))
    placed = staging.write(placed, "weights")
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    wanted, capped, taken, shared = budget * total, -1, 0.0, 0
    level = F.lit(0.0)
    while True:
        # Sources at their limit are those whose share at the present level is beyond it; the level only rises.
        above = F.col("weight") * level > most * F.col("size")
        row = placed.agg(
            F.count(F.when(above, 1)).alias("n"), F.coalesce(F.sum(F.when(above, most * F.col("size"))), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if row["n"] == capped or not row["weight"]:
            break
        capped, taken, shared = row["n"], row["taken"], row["weight"]
        level = F.lit((wanted - taken) / shared)
    target = F.when(above, (most * F.col("size")).cast("double")).otherwise(F.col("weight") * F.lit(float(wanted - taken)) / F.lit(shared or 1))
    return Mix(staging.write(placed.withColumn("target", target), "targets"))


def line_up(*columns: str) -> Column:
    """A number of 60 bits from a digest of the columns: the same in every run, and without regard to their order."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns])), 1, 15), 16, 10).cast("long")


def arrange(docs: DataFrame, size: Column, source: str = "source", line: Column | None = None, **schedule) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with source_size, target, taken and positions; and the names that these columns got.

    Documents of a source are lined up by ``line``, a number of 60 bits (default: a digest of all columns), and taken from the start,
    again and again, as long as the middle of the next one is below the target: every document floor or ceil of target /
    source size times, so at most twice. ``taken`` counts its words with repeats; ``positions`` has one training
    time per copy. Rows with equal numbers and sizes are exchangeable.
    Sources of size 0 have target 0. Names that ``docs`` has already get an underscore.
    """
    staging = Staging(docs.sparkSession)
    names = {c: fresh(docs, c) for c in ("size", "source_size", "target", "taken", "positions")}
    own = {c: fresh(docs, f"mix_{c}") for c in ("order", "bucket", "key", "begin", "target", "source_size", "tilt", "before")}
    line = line_up(*docs.columns) if line is None else line
    sized = docs.withColumns({names["size"]: size, own["order"]: line})
    slim = staging.write(sized.select(F.col(source).alias("source"), F.col(names["size"]).alias("size"), F.col(own["order"]).alias("line")), "sizes")
    sums = staging.write(slim.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "sums")
    mix = targets(sums.select("source", "size"), staging, **schedule)
    largest = sums.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    bits = max(1, (largest // BUCKET_ROWS).bit_length())
    bucket = lambda c: F.shiftright(c, 60 - bits)
    key = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    chunks = slim.groupBy(key(F.col("source")).alias(own["key"]), bucket(F.col("line")).alias(own["bucket"])).agg(F.sum("size").alias("in_bucket"))
    running = F.sum("in_bucket").over(Window.partitionBy(own["key"]).orderBy(own["bucket"])) - F.col("in_bucket")
    known = mix.sources.select(key(F.col("source")).alias(own["key"]), F.col("size").alias(own["source_size"]), F.col("target").alias(own["target"]), F.col("tilt").alias(own["tilt"]))
    offsets = chunks.withColumn(own["before"], running).drop("in_bucket").join(known, own["key"])

    spread = sized.withColumns({own["key"]: key(F.col(source)), own["bucket"]: bucket(F.col(own["order"]))}).join(offsets, [own["key"], own["bucket"]])
    inside = F.sum(names["size"]).over(Window.partitionBy(own["key"], own["bucket"]).orderBy(own["order"], names["size"]).rowsBetween(Window.unboundedPreceding, 0)) - F.col(names["size"])
    begun = spread.withColumn(own["begin"], F.col(own["before"]) + inside)
    middle = F.col(own["begin"]) + F.col(names["size"]) / 2
    most = schedule.get("most", MOST_REPEATS)
    times = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: middle + k * F.col(own["source_size"])), lambda m: m < F.col(own["target"]))
    positions = F.transform(times, lambda m: demand_position(m / F.col(own["target"]), F.col(own["tilt"])))
    out = begun.withColumn(names["positions"], positions).withColumns({
        names["source_size"]: F.col(own["source_size"]), names["target"]: F.col(own["target"]), names["taken"]: F.size(names["positions"]) * F.col(names["size"]),
    })
    return out.select(*docs.columns, *names.values()), names


def in_training_order(arranged: DataFrame, positions: str, *ties: str) -> DataFrame:
    """The rows of an arrangement range-sorted by their first position, those not taken last; ``ties`` orders equal ones."""
    first, tie = fresh(arranged, "first_position"), fresh(arranged, "tie")
    order = [F.col(first).asc_nulls_last(), F.col(tie)]
    placed = arranged.withColumns({first: F.get(positions, F.lit(0)), tie: F.xxhash64(*ties)})
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).drop(first, tie)


def mixed(docs: DataFrame, text: str = "text", source: str = "source", **schedule) -> DataFrame:
    """The mix itself: a row of ``docs`` per copy taken, range-sorted by the added column ``position``."""
    arranged, names = arrange(docs, n_words(F.col(text)), source, **schedule)
    position = fresh(docs, "position")
    copies = arranged.select(*docs.columns, F.explode(names["positions"]).alias(position))
    tie = fresh(copies, "tie")
    copies = copies.withColumn(tie, F.xxhash64(*docs.columns))
    return copies.repartitionByRange(position, tie).sortWithinPartitions(position, tie).drop(tie)
