"""Q1-Q8: the analytical queries and views over the star schema.

Sums go over decimal columns, so they do not depend on the order of addition. Where it keeps the
result, the fact is aggregated on its surrogate key before it meets a dimension: hot keys are combined
on the map side, and the join sees one row per key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.lookup import is_broadcast
from tillroll.operators.ordering import rank_descending
from tillroll.operators.staging import Staging
from tillroll.sources.schemas import MONEY
from tillroll.sources.warehouse import SALE_YEAR, Warehouse

# A window without partitions may see as many rows as this; more are ranked by range, with the same result.
SMALL_ROWS = 100_000

# The columns of the flat view.
FLAT_COLUMNS = [
    "sale_key", "order_id", "full_date", "year", "quarter", "month_name", "weekday_name", "customer_id",
    "customer_name", "product_name", "category", "region_name", "payment_method", "sales_channel", "quantity",
    "unit_price", "discount_percent", "gross_amount", "discount_amount", "net_amount", "cost_amount",
    "profit_amount",
]


def _percent(part: Column, whole: Column) -> Column:
    """Null instead of an error when the whole is zero."""
    return F.try_divide(F.lit(100) * part, whole)


def monthly_revenue(wh: Warehouse) -> DataFrame:
    """Q1. LAG steps over months that have sales. There are at most 12 months for each of 9999 years."""
    per_day = wh["fact_sales"].groupBy("date_key").agg(F.sum("net_amount").alias("revenue"))
    months = (
        per_day.join(wh["dim_date"], "date_key")
        .groupBy("year", "month", "month_name")
        .agg(F.sum("revenue").alias("revenue"))
    )
    previous = F.lag("revenue").over(Window.orderBy("year", "month"))
    return (
        months.withColumn("prev_month_revenue", previous)
        .withColumn(
            "mom_growth_percent",
            F.round(_percent(F.col("revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue")), 2),
        )
        .orderBy("year", "month")
        .select("year", "month_name", "revenue", "prev_month_revenue", "mom_growth_percent")
    )


def category_profit(wh: Warehouse, staging: Staging | None = None, small_rows: int = SMALL_ROWS) -> DataFrame:
    """Q2; a category without profit comes last. There are no more categories than products, which tells how to rank them."""
    per_product = wh["fact_sales"].groupBy("product_key").agg(
        F.sum("net_amount").alias("revenue"), F.sum("profit_amount").alias("profit")
    )
    categories = (
        per_product.join(wh["dim_product"], "product_key")
        .groupBy("category")
        .agg(F.sum("revenue").alias("total_revenue"), F.sum("profit").alias("total_profit"))
        .withColumn("profit_margin_percent", F.round(_percent(F.col("total_profit"), F.col("total_revenue")), 2))
    )
    if wh.rows("dim_product") <= small_rows:
        best_first = Window.orderBy(F.col("total_profit").desc())
        ranked = categories.withColumn("profit_rank", F.rank().over(best_first))
    else:
        staging = staging or Staging(categories.sparkSession)
        categories = staging.write(categories, "categories")
        ranked = rank_descending(categories, "total_profit", "profit_rank", staging, "category_rank")
    return ranked.orderBy(F.col("total_profit").desc()).select(
        "category", "total_revenue", "total_profit", "profit_margin_percent", "profit_rank"
    )


def top_product(wh: Warehouse) -> DataFrame:
    """Q3. Equal revenues go to the first product by name."""
    per_product = wh["fact_sales"].groupBy("product_key").agg(
        F.sum("net_amount").alias("revenue"), F.sum("quantity").alias("units_sold")
    )
    sales = (
        per_product.join(wh["dim_product"], "product_key")
        .groupBy("category", "product_name")
        .agg(F.sum("revenue").alias("revenue"), F.sum("units_sold").alias("units_sold"))
    )
    best_first = Window.partitionBy("category").orderBy(F.col("revenue").desc(), "product_name")
    return (
        sales.withColumn("rnk", F.row_number().over(best_first))
        .where(F.col("rnk") == 1)
        .orderBy(F.col("revenue").desc())
        .select("category", "product_name", "revenue", "units_sold")
    )


def region_share(wh: Warehouse, staging: Staging | None = None) -> DataFrame:
    """Q4. ``avg_order_value`` is the mean per line."""
    per_key = wh["fact_sales"].groupBy("region_key").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("net_amount").alias("total_revenue"),
        F.count("net_amount").alias("n_lines"),
    )
    known = per_key.join(wh["dim_region"], "region_key")
    if wh.rows("dim_region") <= SMALL_ROWS:
        known = known.withColumn("whole", F.sum("total_revenue").over(Window.partitionBy()))
    else:
        # Written, since the total would otherwise scan the fact again.
        known = (staging or Staging(known.sparkSession)).write(known, "regions")
        known = known.withColumn("whole", known.agg(F.sum("total_revenue")).scalar())
    return known.orderBy(F.col("total_revenue").desc()).select(
        "region_name",
        "total_orders",
        "total_revenue",
        F.round(F.try_divide("total_revenue", "n_lines"), 2).alias("avg_order_value"),
        F.round(_percent(F.col("total_revenue"), F.col("whole")), 2).alias("pct_of_total_revenue"),
    )


def customer_segments(wh: Warehouse) -> DataFrame:
    """Q5. Only the number of orders decides the segment. Date keys sort as their dates do, so the last day is looked up once per customer."""
    per_key = (
        wh["fact_sales"].groupBy("customer_key")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.sum("net_amount").alias("lifetime_value"),
            F.max("date_key").alias("date_key"),
        )
    )
    per_key = wh.attach(per_key, "dim_date", "date_key", ["full_date"]).withColumnRenamed("full_date", "last_purchase_date")
    # The segments and their bounds.
    orders = F.col("order_count")
    segment = F.when(orders == 1, "One-time").when(orders.between(2, 4), "Occasional").otherwise("Loyal")
    return (
        per_key.join(wh["dim_customer"], "customer_key")
        .orderBy(F.col("lifetime_value").desc(), "customer_id")
        .select(
            "customer_id", "customer_name", "order_count", "lifetime_value", "last_purchase_date",
            segment.alias("customer_segment"),
        )
    )


def top_customers(wh: Warehouse, n: int = 5) -> DataFrame:
    """Q5 and L2: the first ``n`` by lifetime value; equal values in order of their ids."""
    return customer_segments(wh).limit(n)


def repeat_share(wh: Warehouse) -> DataFrame:
    """Q6, unrounded."""
    per_key = wh["fact_sales"].groupBy("customer_key").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("net_amount").alias("ltv")
    )
    known = per_key.join(wh["dim_customer"].select("customer_key"), "customer_key")
    repeat = F.col("order_count") > 1

    def share(part: Column, whole: Column) -> Column:
        return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))

    return known.agg(
        share(F.sum(F.when(repeat, 1).otherwise(0)), F.count("*")).alias("pct_repeat_customers"),
        share(F.sum(F.when(repeat, F.col("ltv")).otherwise(0)), F.sum("ltv")).alias("pct_revenue_from_repeat"),
    )


def sales_flat(wh: Warehouse, staging: Staging | None = None) -> DataFrame:
    """Q7. A filter on ``year`` also reaches the fact's partitions.

    Dimensions that move the lines come first, the one with the narrowest rows before the others, so that lines move without
    what broadcast dimensions say of them, and without the amounts that follow from others. With ``staging``, as for an
    export, they are written between two moves, so that the files of one shuffle are gone when the next begins.
    """
    columns = {
        "dim_date": ("date_key", [c for c in wh["dim_date"].columns if c not in ("date_key", "year")]),
        "dim_product": ("product_key", ["product_name", "category"]),
        "dim_region": ("region_key", ["region_name"]),
        "dim_customer": ("customer_key", ["customer_id", "customer_name"]),
    }
    moving = sorted((name for name in columns if not is_broadcast(wh.size(name))), key=lambda name: wh.size(name) / wh.rows(name))
    flat = wh["fact_sales"].withColumn("year", F.col(SALE_YEAR))
    flat = _without_amounts(flat) if moving else flat
    for i, name in enumerate(moving):
        flat = staging.write(flat, f"flat_lines-{i}") if staging and i else flat
        flat = wh.attach(flat, name, *columns[name])
    flat = _with_amounts(flat) if moving else flat
    for name in columns:
        flat = flat if name in moving else wh.attach(flat, name, *columns[name])
    return flat.select(*FLAT_COLUMNS)


def _following() -> dict[str, Column]:
    """Amounts of the fact as they mostly follow from other columns, exactly, in decimals; each may use those before it."""
    gross = (F.col("unit_price") * F.col("quantity")).try_cast(MONEY)
    net = (gross - F.col("discount_amount")).try_cast(MONEY)
    return {"gross_amount": gross, "net_amount": net, "profit_amount": (net - F.col("cost_amount")).try_cast(MONEY)}


def _without_amounts(lines: DataFrame) -> DataFrame:
    """Null in place of amounts that follow, where all of a line's do (``_follow``), which takes next to no room in a shuffle."""
    follow = reduce(and_, [F.col(name).eqNullSafe(value) for name, value in _following().items()])
    marked = lines.withColumn("_follow", follow)
    return marked.withColumns({name: F.when(~F.col("_follow"), F.col(name)) for name in _following()})


def _with_amounts(lines: DataFrame) -> DataFrame:
    """The lines as they were before ``_without_amounts``."""
    return lines.withColumns({name: F.when(F.col("_follow"), value).otherwise(F.col(name)) for name, value in _following().items()})


def monthly_kpis(wh: Warehouse) -> DataFrame:
    """Q8. ``avg_order_value`` is the mean per line."""
    lines = wh["fact_sales"].select("date_key", "order_id", "net_amount", "profit_amount")
    dated = wh.attach(lines, "dim_date", "date_key", ["year", "month", "month_name"])
    return dated.groupBy("year", "month", "month_name").agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("net_amount").alias("revenue"),
        F.sum("profit_amount").alias("profit"),
        F.round(F.try_divide(F.sum("net_amount"), F.count("net_amount")), 2).alias("avg_order_value"),
    )


def register_views(wh: Warehouse) -> None:
    """The tables and both views under their SQL names; monthly figures are those stored with the run, if there are any."""
    for name, table in wh.tables.items():
        table.createOrReplaceTempView(name)
    sales_flat(wh).createOrReplaceTempView("vw_sales_flat")
    (monthly_kpis(wh) if wh.monthly is None else wh.monthly).createOrReplaceTempView("vw_monthly_kpis")
