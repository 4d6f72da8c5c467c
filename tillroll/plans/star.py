"""One fact and four dimensions out of the cleaned lines."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import date_attributes, date_key
from tillroll.functions.numbers import derive_amounts
from tillroll.operators.firsts import first_values
from tillroll.operators.lookup import is_broadcast, lookup, measured_bytes
from tillroll.operators.ordering import freeze_in_order, number_rows
from tillroll.operators.staging import Staging, side_by_side
from tillroll.sources.schemas import AMOUNT_COLUMNS, FACT_SALES
from tillroll.sources.warehouse import HOT_LINES, hot_keys

# Folder of the written tables of lines between two lookups that shuffle them.
KEYED_LINES = "keyed_lines"


def keyed_dimension(
    clean: DataFrame, natural_key: str, payload: list[str], surrogate_key: str, staging: Staging
) -> DataFrame:
    """One row per natural key, numbered by first appearance in the feed.

    Keeps ``n_lines``, by which the fact's lookup tells hot keys.
    """
    members = first_values(clean, natural_key, payload, "line_no", staging)
    frozen = freeze_in_order(members, ["first_line"], staging, surrogate_key)
    numbered = number_rows(frozen, surrogate_key)
    numbered = numbered.withColumn(surrogate_key, F.col(surrogate_key).cast("int"))
    return numbered.select(surrogate_key, natural_key, *payload, "n_lines")


def customers(clean: DataFrame, staging: Staging) -> DataFrame:
    """P4."""
    return keyed_dimension(clean, "customer_id", ["customer_name"], "customer_key", staging)


def products(clean: DataFrame, staging: Staging) -> DataFrame:
    """P5."""
    return keyed_dimension(clean, "product_name", ["category"], "product_key", staging)


def regions(clean: DataFrame, staging: Staging) -> DataFrame:
    """P6."""
    return keyed_dimension(clean, "region", [], "region_key", staging).withColumnRenamed("region", "region_name")


def dates(clean: DataFrame) -> DataFrame:
    """Only dates that occur."""
    return clean.select("order_date").distinct().select(*date_attributes(F.col("order_date")))


def key_hash(name: str) -> Column:
    """64 bits by which lines meet their dimension; null for null."""
    return F.when(F.col(name).isNotNull(), F.xxhash64(name))


def hashes_differ(table: DataFrame, key: str) -> bool:
    """Whether no two of the natural keys share a hash, so that hashes can stand for them."""
    counts = table.where(F.col(key).isNotNull()).agg(F.count("*").alias("n"), F.count_distinct(key_hash(key)).alias("hashes")).first()
    return counts["n"] == counts["hashes"]


def fact(clean: DataFrame, customer: DataFrame, product: DataFrame, region: DataFrame, staging: Staging | None = None) -> DataFrame:
    """Natural keys replaced by surrogate keys, ``sale_key`` in feed order.

    Lines have a row in every dimension, and meet it by a hash of the natural key, or by the key itself where two keys of the
    dimension share one. So keys as text are neither broadcast nor moved. Where dimensions are beyond the broadcast bound, lines
    are shuffled without their amounts, which are derived behind it. With ``staging``, lines that are shuffled a second time are
    written before (KEYED_LINES, for the caller to drop), so that the files of one shuffle are gone when the next begins.

    A value that does not fit its column turns null here and fails the NOT NULL check before the
    tables are published, with a count, instead of ending the job on one row.
    """
    types = {field.name: field.dataType for field in FACT_SALES}

    def fitted(name: str) -> Column:
        return F.col(name).try_cast(types[name]).alias(name)

    dimensions = {
        "region_name": region.select("region_name", "region_key", "n_lines"),
        "product_name": product.select("product_name", "product_key", "n_lines"),
        "customer_id": customer.select("customer_id", "customer_key", "n_lines"),
    }
    told = side_by_side(clean.sparkSession, *[partial(hashes_differ, table, key) for key, table in dimensions.items()])
    keyed, by = clean.drop(*AMOUNT_COLUMNS).withColumnRenamed("region", "region_name"), {}
    for (key, table), differ in zip(dimensions.items(), told, strict=True):
        by[key] = f"{key}_hash" if differ else key
        dimensions[key] = table.withColumn(by[key], key_hash(key)).drop(key) if differ else table
        keyed = keyed.withColumn(by[key], key_hash(key)).drop(key) if differ else keyed
    sizes = side_by_side(clean.sparkSession, *[partial(measured_bytes, table.drop("n_lines")) for table in dimensions.values()])
    moved = False
    for (key, table), size in zip(dimensions.items(), sizes, strict=True):
        moves = not is_broadcast(size)
        if moves and moved and staging:
            keyed = staging.write(keyed, f"{KEYED_LINES}/{key}")
        moved = moved or moves
        keyed = lookup(keyed, table, by[key], weight="n_lines", table_bytes=size).drop(by[key])
    computed = {"sale_key": F.col("line_no").alias("sale_key"), "date_key": date_key(F.col("order_date")).alias("date_key")}
    return derive_amounts(keyed).select(*[computed.get(name, fitted(name)) for name in types])


def build_star(clean: DataFrame, staging: Staging) -> dict[str, DataFrame]:
    """The five tables and the hot keys of the fact, not yet written."""
    customer, product, region = side_by_side(
        clean.sparkSession,
        lambda: customers(clean, staging),
        lambda: products(clean, staging),
        lambda: regions(clean, staging),
    )
    return {
        "dim_customer": customer.drop("n_lines"),
        "dim_product": product.drop("n_lines"),
        "dim_region": region.drop("n_lines"),
        "dim_date": dates(clean),
        "fact_sales": fact(clean, customer, product, region, staging),
        HOT_LINES: hot_keys({"customer_key": customer, "product_key": product, "region_key": region}),
    }
