"""The flat export for dashboards and the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import iso_date
from tillroll.sources.feed import write_csv

# Text and layout of the report.
TITLE = "RETAIL SALES PIPELINE — DATA QUALITY REPORT"
RULE = "=" * 50
TRANSFORM_HEADING = "-- Transform stage findings --"
LOAD_HEADING = "-- Final row counts loaded into warehouse --"
NAME_WIDTH = 30


def report_lines(metrics: DataFrame, counts: DataFrame) -> DataFrame:
    """S9 as (section, position, line): section 0 is the head, 1 the metrics, 2 the table counts."""
    heads = [
        (0, 1, TITLE), (0, 2, RULE), (0, 3, ""), (1, 0, TRANSFORM_HEADING),
        (2, -1, ""), (2, 0, LOAD_HEADING),
    ]
    rows = F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(position).alias("position"), F.lit(line).alias("line"))
        for section, position, line in heads
    ])
    head = metrics.sparkSession.range(1, numPartitions=1).select(F.inline(rows))

    def body(df: DataFrame, section: int) -> DataFrame:
        line = F.concat(F.rpad("metric", NAME_WIDTH, " "), F.lit(": "), F.col("value").cast("string"))
        return df.select(F.lit(section).alias("section"), "position", line.alias("line"))

    return head.unionByName(body(metrics, 1)).unionByName(body(counts, 2))


def write_report(metrics: DataFrame, counts: DataFrame, path: str) -> None:
    """One text file of some 20 lines."""
    lines = report_lines(metrics, counts).orderBy("section", "position").select("line")
    lines.coalesce(1).write.mode("overwrite").text(path)


def write_flat_csv(flat: DataFrame, path: str, compression: str | None = None) -> None:
    """The flat view as text with a header."""
    write_csv(flat.withColumn("full_date", iso_date(F.col("full_date"))), path, compression)
