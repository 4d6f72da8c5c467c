"""The registered queries. Each runs over the whole feed derived from the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness.workspace import TEXT_COMPRESSION, Workspace, workspace
from tillroll.functions.dates import date_attributes, parse_order_date
from tillroll.functions.numbers import COST_RATIO, coerce_number, derive_amounts, discount_or_zero
from tillroll.functions.text import canonical_category, clean_text, null_reader_tokens, title_case
from tillroll.operators.positions import POSITION, with_positions
from tillroll.operators.staging import Staging
from tillroll.plans import analytics, quality
from tillroll.plans.cleaning import cap_outliers, dedup_lines, drop_invalid, impute_defaults
from tillroll.sources.feed import read_feed, with_nulls, write_clean_csv, write_csv
from tillroll.sources.reports import report_lines, write_flat_csv
from tillroll.sources.schemas import CLEAN_COLUMNS, ORDINAL, RAW_COLUMNS

Query = Callable[[Workspace], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines report alike: bigint, double and text."""
    columns = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.DoubleType)):
            c = c.cast("double") + F.lit(0.0)  # no negative zero
        columns.append(c.alias(f.name))
    return df.select(*columns)


# --- scalars ---


def null_tokens(ws: Workspace) -> DataFrame:
    cells = {c: clean_text(F.col(c)).alias(c) for c in ("customer_name", "region", "category")}
    return ws.raw.select("order_id", *cells.values(), null_reader_tokens(F.col("discount_percent")).alias("discount_percent"))


def title_cased(ws: Workspace) -> DataFrame:
    return ws.raw.select("order_id", *[title_case(clean_text(F.col(c))).alias(c) for c in ("region", "product_name", "category")])


def canonical(ws: Workspace) -> DataFrame:
    label = canonical_category(title_case(clean_text(F.col("category"))))
    return ws.raw.select("order_id", label.alias("category"))


def imputed(ws: Workspace) -> DataFrame:
    return impute_defaults(ws.lines).select("order_id", "customer_name", "region")


def parsed_dates(ws: Workspace) -> DataFrame:
    return ws.raw.select("order_id", F.col("order_date").alias("text"), parse_order_date(F.col("order_date")).alias("order_date"))


def attributes(ws: Workspace) -> DataFrame:
    dated = ws.lines.where(F.col("order_date").isNotNull())
    return dated.select("order_id", *date_attributes(F.col("order_date")))


def coerced(ws: Workspace) -> DataFrame:
    return ws.raw.select(
        "order_id",
        coerce_number(F.col("quantity")).alias("quantity"),
        coerce_number(F.col("unit_price")).alias("unit_price"),
        discount_or_zero(F.col("discount_percent")).alias("discount_percent"),
    )


def amounts(ws: Workspace) -> DataFrame:
    return derive_amounts(drop_invalid(ws.lines)).select(
        "order_id", "category", "quantity", "unit_price", "discount_percent", "gross_amount", "discount_amount",
        "net_amount", "cost_ratio", "cost_amount", "profit_amount",
    )


# --- cleaning ---


def valid_lines(ws: Workspace) -> DataFrame:
    return drop_invalid(ws.lines).drop(ORDINAL)


def capped(ws: Workspace) -> DataFrame:
    lines = cap_outliers(drop_invalid(ws.typed), ws.medians)
    return lines.select("order_id", "product_name", "category", "quantity", "unit_price")


def deduplicated(ws: Workspace) -> DataFrame:
    staging = Staging(ws.spark)
    valid = drop_invalid(with_positions(ws.typed, ORDINAL, staging))
    return dedup_lines(cap_outliers(valid, ws.medians), staging).drop(ORDINAL, POSITION, "line_no")


def feed_csv(ws: Workspace) -> DataFrame:
    """The feed as CSV files, read back, lines numbered in input order."""
    staging = Staging(ws.spark)
    lines = with_positions(staging.write(with_nulls(read_feed(ws.spark, ws.text)), "lines"), ORDINAL, staging)
    return lines.withColumn("input_line", F.col(POSITION) + 1).drop(ORDINAL, POSITION)


def feed_csv_breaks(ws: Workspace) -> DataFrame:
    """S1 and S3 with quoted line breaks: every fifth product name goes on in a second line, which begins with a quote."""
    path, staging = f"{Staging(ws.spark).folder}/broken_text", Staging(ws.spark)
    broken = F.concat("product_name", F.lit(',\n"'), "order_id")
    lines = ws.in_order.withColumn("product_name", F.when(F.substring("order_id", 4, 20).cast("bigint") % 5 == 0, broken).otherwise(F.col("product_name")))
    write_csv(lines.select(*RAW_COLUMNS), path, TEXT_COMPRESSION)
    read = with_positions(staging.write(with_nulls(read_feed(ws.spark, path, staging=staging)), "lines_read"), ORDINAL, staging)
    line = F.row_number().over(Window.partitionBy("order_id").orderBy(POSITION))
    return read.select("order_id", "product_name", "quantity", "sales_channel", line.alias("line_of_order"))


def clean_csv(ws: Workspace) -> DataFrame:
    """The cleaned text file, read back."""
    path = f"{Staging(ws.spark).folder}/clean_csv"
    write_clean_csv(ws.load.cleaned.lines, path, compression=TEXT_COMPRESSION)
    texts = ws.spark.read.csv(path, header=True, escape='"')
    numbers = {"quantity", "unit_price", "discount_percent", *CLEAN_COLUMNS[12:]}
    return texts.select(*[F.col(c).cast("double").alias(c) if c in numbers else c for c in CLEAN_COLUMNS])


def flat_csv(ws: Workspace) -> DataFrame:
    """The flat export, read back."""
    path = f"{Staging(ws.spark).folder}/flat_csv"
    with Staging(ws.spark) as staging:
        write_flat_csv(analytics.sales_flat(ws.load.warehouse, staging), path, TEXT_COMPRESSION)
    texts = ws.spark.read.csv(path, header=True, escape='"')
    numbers = {"sale_key": "bigint", "year": "bigint", "quarter": "bigint", "quantity": "bigint"}
    numbers |= {c: "double" for c in analytics.FLAT_COLUMNS[-7:]}
    return texts.select(*[F.col(c).cast(numbers.get(c, "string")).alias(c) for c in analytics.FLAT_COLUMNS])


def view(name: str) -> Query:
    def run(ws: Workspace) -> DataFrame:
        analytics.register_views(ws.load.warehouse)
        return ws.spark.sql(f"SELECT * FROM {name}")

    return run


def dim(name: str) -> Query:
    return lambda ws: ws.load.warehouse[name]


def appended_view(name: str) -> Query:
    def run(ws: Workspace) -> DataFrame:
        analytics.register_views(ws.appended)
        return ws.spark.sql(f"SELECT * FROM {name}")

    return run


def sales_fact(ws: Workspace) -> DataFrame:
    return ws.load.warehouse["fact_sales"].drop("sale_year")


def unpriced_orphans(ws: Workspace) -> DataFrame:
    """Product keys of the fact that a dimension of the categories with a known cost lacks."""
    known = ws.load.warehouse["dim_product"].where(F.col("category").isin(list(COST_RATIO)))
    return quality.orphan_keys(ws.load.warehouse["fact_sales"], known, "product_key")


def order_duplicates(ws: Workspace) -> DataFrame:
    return quality.duplicate_groups(ws.load.warehouse["fact_sales"], ["order_id", "product_key", "date_key"])


def quality_report(ws: Workspace) -> DataFrame:
    return report_lines(quality.dq_metrics(ws.load.cleaned), quality.load_counts(ws.load.warehouse))


QUERIES: dict[str, Query] = {
    "null_tokens": null_tokens,
    "title_case": title_cased,
    "canonical_category": canonical,
    "impute_defaults": imputed,
    "parse_dates": parsed_dates,
    "date_attributes": attributes,
    "coerce_numbers": coerced,
    "derive_amounts": amounts,
    "drop_invalid": valid_lines,
    "line_profile": lambda ws: ws.profile.drop("slot"),
    "category_median": lambda ws: ws.medians,
    "cap_outliers": capped,
    "dedup_lines": deduplicated,
    "clean_sales": lambda ws: ws.load.cleaned.lines,
    "feed_csv": feed_csv,
    "feed_csv_breaks": feed_csv_breaks,
    "clean_csv": clean_csv,
    "dim_customer": dim("dim_customer"),
    "dim_product": dim("dim_product"),
    "dim_region": dim("dim_region"),
    "dim_date": dim("dim_date"),
    "fact_sales": sales_fact,
    "append_fact": lambda ws: ws.appended["fact_sales"].drop("sale_year"),
    "append_flat": appended_view("vw_sales_flat"),
    "append_monthly": appended_view("vw_monthly_kpis"),
    "append_counts": lambda ws: quality.load_counts(ws.appended),
    "monthly_revenue": lambda ws: analytics.monthly_revenue(ws.load.warehouse),
    "category_profit": lambda ws: analytics.category_profit(ws.load.warehouse),
    "category_profit_by_range": lambda ws: analytics.category_profit(ws.load.warehouse, Staging(ws.spark), small_rows=0),
    "top_product": lambda ws: analytics.top_product(ws.load.warehouse),
    "region_share": lambda ws: analytics.region_share(ws.load.warehouse),
    "customer_segments": lambda ws: analytics.customer_segments(ws.load.warehouse),
    "top_customers": lambda ws: analytics.top_customers(ws.load.warehouse),
    "repeat_share": lambda ws: analytics.repeat_share(ws.load.warehouse),
    "sales_flat": view("vw_sales_flat"),
    "monthly_kpis": view("vw_monthly_kpis"),
    "flat_csv": flat_csv,
    "dq_metrics": lambda ws: quality.dq_metrics(ws.load.cleaned),
    "load_counts": lambda ws: quality.load_counts(ws.load.warehouse),
    "dq_report": quality_report,
    "warehouse_checks": lambda ws: quality.warehouse_checks(ws.load.warehouse),
    "constraint_checks": lambda ws: quality.constraint_checks(ws.load.warehouse),
    "orphan_keys": unpriced_orphans,
    "duplicate_groups": order_duplicates,
}


def registered(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(QUERIES[name](workspace(spark, sf_dir)))

    run.__name__ = name
    return run
