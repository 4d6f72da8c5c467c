"""Numbers from text, rounding, and the derived money columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cost as a share of the gross amount.
COST_RATIO = {
    "Electronics": 0.68,
    "Apparel": 0.55,
    "Home & Kitchen": 0.62,
    "Beauty": 0.50,
    "Sports": 0.58,
}
DEFAULT_COST_RATIO = 0.60

_BLANKS = r"[ \t\n\x0B\f\r]*"
_INFINITE = r"[+-]?(?i:inf(?:inity)?)"
_INFINITE_TEXT = f"^{_BLANKS}{_INFINITE}{_BLANKS}$"
_NUMBER_TEXT = f"^{_BLANKS}(?:[+-]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?|{_INFINITE}){_BLANKS}$"


def coerce_number(c: Column) -> Column:
    """Double, or null for text that is no number.

    The pattern keeps out what only the JVM reads as a number (type suffixes, hexadecimal). A decimal
    text too large for a double is null, and NaN never comes out, since NaN > 0 holds in Spark.
    """
    number = F.when(c.rlike(_NUMBER_TEXT), c).try_cast("double")
    return F.when((F.abs(number) < float("inf")) | c.rlike(_INFINITE_TEXT), number)


def discount_or_zero(c: Column) -> Column:
    """N2."""
    return F.coalesce(coerce_number(c), F.lit(0.0))


def round_cents(x: Column) -> Column:
    """Half to even after scaling, as array libraries round; Spark's round and bround differ."""
    return F.rint(x * 100) / 100


def cost_ratio(category: Column) -> Column:
    """N8."""
    ratios = F.create_map(*[F.lit(x) for pair in COST_RATIO.items() for x in pair])
    return F.coalesce(F.try_element_at(ratios, category), F.lit(DEFAULT_COST_RATIO))


def derive_amounts(lines: DataFrame) -> DataFrame:
    """Gross, discount, net, cost ratio, cost and profit. Cost is on gross, not on net."""
    return (
        lines.withColumn("gross_amount", round_cents(F.col("quantity") * F.col("unit_price")))
        .withColumn("discount_amount", round_cents(F.col("gross_amount") * F.col("discount_percent") / 100))
        .withColumn("net_amount", round_cents(F.col("gross_amount") - F.col("discount_amount")))
        .withColumn("cost_ratio", cost_ratio(F.col("category")))
        .withColumn("cost_amount", round_cents(F.col("gross_amount") * F.col("cost_ratio")))
        .withColumn("profit_amount", round_cents(F.col("net_amount") - F.col("cost_amount")))
    )
