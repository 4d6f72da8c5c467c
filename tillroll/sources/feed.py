"""The all-text sales feed, its input order, and the cleaned text file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.dates import iso_date
from tillroll.functions.text import null_reader_tokens
from tillroll.operators.positions import block_place
from tillroll.operators.staging import Staging
from tillroll.sources.records import Records, has_open_quotes, read_records
from tillroll.sources.schemas import CLEAN_COLUMNS, ORDINAL, RAW_COLUMNS

_OVERLONG = "_overlong"


def read_feed(spark: SparkSession, path: str | list[str], multi_line: bool | None = None, staging: Staging | None = None) -> DataFrame:
    """The 12 feed columns as text, bound by header name, plus ``src_ordinal``.

    Files are split among tasks. In a feed with quoted line breaks (``multi_line``; None looks for one in a pass over the text)
    the lines are first put together to records, with intermediate tables in ``staging``. A line with more fields than the
    header ends the job that reads it; a shorter one is filled up with nulls; blank lines are left out. Every file begins with
    the same header. The order is that of paths, then of places in the file.
    """
    if multi_line is None:
        multi_line = has_open_quotes(spark, path)
    options = {"header": True, "escape": '"', "enforceSchema": False}
    names = spark.read.csv(path, multiLine=multi_line, **options).columns
    missing = [c for c in RAW_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"the feed lacks the columns {missing}")
    # Lines whose number of fields is another than the header's come with their text beside what could be read.
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _OVERLONG]])
    df = _parsed_records(read_records(spark, path, staging or Staging(spark)), names, schema) if multi_line else None
    if df is None:
        df = spark.read.options(columnNameOfCorruptRecord=_OVERLONG, columnPruning=False).csv(path, schema=schema, multiLine=multi_line, **options)
    unquoted = F.regexp_replace(F.replace(_OVERLONG, F.lit('""'), F.lit("")), '"[^"]*+"', "")
    too_long = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) >= len(names)
    message = F.concat(F.lit(f"a line with more than {len(names)} fields: "), F.substring(_OVERLONG, 1, 200))
    first = F.when(too_long, F.raise_error(message).cast("string")).otherwise(F.col(RAW_COLUMNS[0]))
    # Rows of one block are read by one task in order, so the running id orders them.
    ordinal = F.col(ORDINAL) if ORDINAL in df.columns else block_place()
    return df.select(first.alias(RAW_COLUMNS[0]), *RAW_COLUMNS[1:], ordinal.alias(ORDINAL))


def _parsed_records(records: Records, names: list[str], schema: T.StructType) -> DataFrame | None:
    """The fields of the records without headers; None if some file is not cut at line feeds."""
    if records.n_odd_files:
        return None
    fields = F.from_csv("value", ", ".join(f"`{c}` string" for c in schema.names), {"escape": '"', "columnNameOfCorruptRecord": _OVERLONG})
    parsed = records.rows.select(F.col("place").alias(ORDINAL), "is_header", fields.alias("fields"))
    differs = ~F.array(*[F.col(f"fields.`{c}`") for c in names]).eqNullSafe(F.array(*map(F.lit, names))) | F.col(f"fields.{_OVERLONG}").isNotNull()
    refused = F.raise_error(F.concat(F.lit("a file's header differs from the first file's: "), F.col(f"{ORDINAL}.path"))).cast("boolean")
    kept = parsed.where(F.when(~F.col("is_header"), True).when(differs, refused).otherwise(False))
    return kept.select(*[F.col(f"fields.`{c}`").alias(c) for c in schema.names], ORDINAL)


def with_nulls(raw: DataFrame) -> DataFrame:
    """S2 on every feed column."""
    return raw.select(
        *[null_reader_tokens(F.col(c)).alias(c) for c in RAW_COLUMNS],
        *[c for c in raw.columns if c not in RAW_COLUMNS],
    )


def write_clean_csv(clean: DataFrame, path: str, in_feed_order: bool = False, compression: str | None = None) -> None:
    """The cleaned lines as text; ``in_feed_order`` sorts them, at the price of a shuffle."""
    if in_feed_order:
        clean = clean.orderBy("line_no")
    clean = clean.select(*CLEAN_COLUMNS).withColumn("order_date", iso_date(F.col("order_date")))
    write_csv(clean, path, compression)


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Text as it is: quotes doubled, outer spaces kept, which Spark's writer would trim. A file that is compressed
    (``gzip``) is read by one task."""
    plain = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**plain).csv(path, compression=compression)
