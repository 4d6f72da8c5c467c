"""Exact interpolated medians per group when a group may be larger than a task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.ordering import SLOT, chunk_of


def group_medians(frozen: DataFrame, group: str, value: str, n: str) -> DataFrame:
    """A10: median per group over values with multiplicities, as (group, median, n_values).

    ``frozen`` has one row per distinct (group, value), frozen in the order of both. Sizes per range
    partition tell which partition holds the middle ranks; only rows of those are looked at one by one.
    So no task gets more than one range partition's rows, and a group's running total has one row per
    range partition. Rows whose group or value is null take no part.
    """
    usable = frozen.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    usable = usable.select(group, value, n, SLOT, chunk_of(F.col(SLOT)).alias("chunk"))

    sizes = usable.groupBy(group, "chunk").agg(F.sum(n).alias("chunk_n"))
    in_order = Window.partitionBy(group).orderBy("chunk")
    sizes = sizes.withColumn("before", F.sum("chunk_n").over(in_order) - F.col("chunk_n")).withColumn(
        "total", F.sum("chunk_n").over(Window.partitionBy(group))
    )
    # The one or two middle ranks, counted from 1.
    lower, upper = F.expr("(total + 1) div 2"), F.expr("total div 2 + 1")
    middle = sizes.where((F.col("before") < upper) & (F.col("before") + F.col("chunk_n") >= lower))

    inside = Window.partitionBy(group, "chunk").orderBy(value)
    ranked = (
        usable.join(middle, [group, "chunk"])
        .withColumn("through", F.col("before") + F.sum(n).over(inside))
        .where((F.col("through") >= lower) & (F.col("through") - F.col(n) < upper))
    )
    low, high = F.min(value), F.max(value)
    return ranked.groupBy(group).agg(
        F.when(low == high, low).otherwise((low + high) / 2).alias("median"),
        F.max("total").alias("n_values"),
    )
