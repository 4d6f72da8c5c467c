"""From the text feed to cleaned order lines.

The text is parsed once, into a written table of typed lines, which also fixes the input order. A first
pass over its few needed columns gives a profile, one row per category and valid price, from which come
the medians and the quality counts. A second pass caps and deduplicates.
Counts come from aggregates over these tables, never from accumulators, which would count a task
twice when it runs again after a lost executor.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import parse_year_first, year_first
from tillroll.functions.numbers import coerce_number, derive_amounts, discount_or_zero, round_cents
from tillroll.functions.text import (
    DEFAULT_CUSTOMER_NAME,
    DEFAULT_REGION,
    canonical_category,
    impute,
    null_reader_tokens,
    null_text_tokens,
    strip,
    title_case,
)
from tillroll.operators.firsts import first_positions
from tillroll.operators.lookup import keys_fit, lookup
from tillroll.operators.medians import group_medians
from tillroll.operators.ordering import freeze_in_order
from tillroll.operators.positions import number_kept, with_positions
from tillroll.operators.staging import Staging
from tillroll.sources.schemas import CLEAN_COLUMNS, ORDINAL, RAW_COLUMNS

TEXT_COLUMNS = ["customer_name", "region", "product_name", "category", "payment_method", "sales_channel"]
TITLE_COLUMNS = ["region", "product_name", "category"]

# A price beyond this many medians of its category is a typing error.
OUTLIER_FACTOR = 5
# Lines equal in these columns are copies of each other.
DEDUP_KEYS = ["order_id", "customer_id", "product_name", "order_date", "quantity", "unit_price"]


def typed_lines(raw: DataFrame) -> DataFrame:
    """Standardized text and typed columns; missing names and regions still null.

    One projection per step: what a step uses twice is a column, computed once, and the code Spark
    generates per step stays small enough for the JVM to compile.
    """
    cells = raw.select(*[null_reader_tokens(F.col(c)).alias(c) for c in RAW_COLUMNS], ORDINAL)
    trimmed = cells.withColumns({c: strip(F.col(c)) for c in [*TEXT_COLUMNS, "order_date"]})
    standard = trimmed.withColumns({
        **{c: null_text_tokens(F.col(c)) for c in TEXT_COLUMNS},
        "order_date": year_first(F.col("order_date")),
        "quantity": coerce_number(F.col("quantity")),
        "unit_price": coerce_number(F.col("unit_price")),
        "discount_percent": discount_or_zero(F.col("discount_percent")),
    })
    titled = standard.withColumns({
        **{c: title_case(F.col(c)) for c in TITLE_COLUMNS},
        "order_date": parse_year_first(F.col("order_date")),
    })
    return titled.withColumn("category", canonical_category(F.col("category")))


def impute_defaults(lines: DataFrame) -> DataFrame:
    """Before any first-wins step, so a default name can win."""
    return lines.withColumn("customer_name", impute(F.col("customer_name"), DEFAULT_CUSTOMER_NAME)).withColumn(
        "region", impute(F.col("region"), DEFAULT_REGION)
    )


def is_valid() -> Column:
    """F1-F3."""
    return F.col("order_date").isNotNull() & (F.col("quantity") > 0) & (F.col("unit_price") > 0)


def drop_invalid(lines: DataFrame) -> DataFrame:
    return lines.where(is_valid())


def profile_lines(lines: DataFrame) -> DataFrame:
    """Counts per (category, valid price); invalid lines count under a null price.

    Combined before the shuffle, so a category with a third of the lines is no hot spot, and as small
    as the number of distinct prices.
    """
    valid = F.coalesce(is_valid(), F.lit(False))

    def count_if(condition: Column, name: str) -> Column:
        return F.sum(condition.cast("long")).alias(name)

    return lines.groupBy("category", F.when(valid, F.col("unit_price")).alias("price")).agg(
        F.count("*").alias("n_lines"),
        count_if(valid, "n_valid"),
        count_if(F.col("order_date").isNull(), "n_invalid_date"),
        count_if(F.col("customer_name").isNull(), "n_no_name"),
        count_if(F.col("region").isNull(), "n_no_region"),
        count_if(F.col("quantity").isNull(), "n_no_quantity"),
        count_if(F.col("unit_price").isNull(), "n_no_price"),
    )


def category_medians(profile: DataFrame) -> DataFrame:
    """A10 over valid lines, copies included: (category, median, n_values)."""
    return group_medians(profile, "category", "price", "n_valid")


def is_outlier(price: Column, median: Column) -> Column:
    return price > median * OUTLIER_FACTOR


def cap_outliers(lines: DataFrame, medians: DataFrame) -> DataFrame:
    """An outlier gets the median itself, rounded. Lines without a category stay as they are."""
    priced = lookup(lines, medians, "category", weight="n_values")
    median = F.col("median")
    capped = F.when(is_outlier(F.col("unit_price"), median), round_cents(median)).otherwise(F.col("unit_price"))
    return priced.withColumn("unit_price", capped).select(*lines.columns)


def dedup_lines(lines: DataFrame, staging: Staging, published: DataFrame | None = None) -> DataFrame:
    """U1, after capping: lines with POSITION, the first of each group of copies, with ``line_no`` 1, 2, 3, ... in feed order.

    Which lines stay is known as bitmaps over positions before any whole line moves. Copies of ``published`` lines (one row of
    hashes per line), met by 128-bit hash, all go.
    """
    firsts = first_positions(lines, DEDUP_KEYS, staging, "first_lines", published)
    return number_kept(lines, firsts, "line_no")


def moves_later(typed: DataFrame) -> bool:
    """Whether customers or products are, about, too many for a broadcast, so that their lookups move the fact's lines."""
    counts = typed.agg(F.approx_count_distinct("customer_id").alias("customers"), F.approx_count_distinct("product_name").alias("products")).first()
    return not (keys_fit(counts["customers"]) and keys_fit(counts["products"]))


def write_clean(kept: DataFrame, typed: DataFrame, staging: Staging) -> DataFrame:
    """Clean lines, written in files of one year each as far as they are large enough.

    The one move of whole lines: the fact, which is partitioned by year, is written from these files without another.
    Where the fact's lookups will move the lines, files of years would be for nothing: lines are written where they are, and
    without amounts, which readers derive.
    """
    kept = kept.select(*RAW_COLUMNS, "line_no")
    if moves_later(typed):
        return derive_amounts(staging.write(kept, "clean")).select(*CLEAN_COLUMNS, "line_no")
    dealt = kept.withColumn("_year", F.year("order_date")).hint("rebalance", "_year").sortWithinPartitions("_year")
    return staging.write(derive_amounts(dealt).select(*CLEAN_COLUMNS, "line_no"), "clean")


@dataclass
class Cleaned:
    """Cleaned lines with ``line_no`` 1, 2, 3, ... in feed order, and what the quality counts need."""

    lines: DataFrame
    profile: DataFrame
    medians: DataFrame


def profile_typed(typed: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """The profile, frozen in price order, and the category medians."""
    profile = freeze_in_order(profile_lines(typed), ["category", "price"], staging, "profile")
    return profile, staging.write(category_medians(profile), "medians")


def clean_sales(raw: DataFrame, staging: Staging) -> Cleaned:
    """``raw`` has the 12 text columns and ``src_ordinal``. The typed lines are deleted once the clean ones are written."""
    typed = staging.write(typed_lines(raw), "typed")
    profile, medians = profile_typed(typed, staging)
    valid = impute_defaults(drop_invalid(with_positions(typed, ORDINAL, staging)))
    kept = dedup_lines(cap_outliers(valid, medians), staging)
    cleaned = Cleaned(write_clean(kept, typed, staging), profile, medians)
    staging.drop("typed")
    return cleaned
