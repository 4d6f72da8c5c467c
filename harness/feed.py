"""A messy sales feed made from the driver tables (FIXTURES.md, section 4). Test input only.

Every defect is a function of ``h = l_orderkey*31 + l_partkey*7 + l_linenumber``, so that SQL can write
the same feed independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.sources.schemas import ORDINAL

CATEGORY_OF_TYPE = {
    "ECONOMY": "Electronics",
    "MEDIUM": "Apparel",
    "LARGE": "Home & Kitchen",
    "PROMO": "Beauty",
    "SMALL": "Sports",
    "STANDARD": "Standard",
}


def _one_of(selector: Column, *choices: Column) -> Column:
    picked = F.when(selector == 0, choices[0])
    for i, choice in enumerate(choices[1:], 1):
        picked = picked.when(selector == i, choice)
    return picked


_LINE = ["l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_linestatus", "p_name", "p_type", "p_retailprice"]
_ORDER = ["o_orderdate", "o_orderpriority", "c_custkey", "c_name", "r_name"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with what the feed says of their customers."""
    nation, region, customer, orders = (_table(spark, sf_dir, name) for name in ("nation", "region", "customer", "orders"))
    geography = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(geography), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", *_ORDER)
    )


def messy_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed, in any order."""
    # The driver's table is one small file with one row group, which a single task would read and write. Dealt by its order,
    # a line does not move again to meet it; customers and countries are joined to the orders, of which there are fewer.
    # The number is fixed, since the few bytes of a line would be merged to fewer tasks than making its text needs.
    sized = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    lineitem = _table(spark, sf_dir, "lineitem").repartition(int(sized or spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    return _as_text(
        lineitem
        .join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )


def feed_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in feed order.

    Lines and orders are sorted by order as one table, so a line meets its order where it is sorted to, and becomes text only there.
    """
    lineitem, part = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "part")
    orders = _orders(spark, sf_dir).where(F.col("o_orderkey").isNotNull())
    lines = lineitem.where(F.col("l_orderkey").isNotNull()).join(part, F.col("l_partkey") == F.col("p_partkey"))
    both = lines.select("l_orderkey", F.lit(1).alias("is_line"), *_LINE).unionByName(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("is_line"), F.struct(*_ORDER).alias("order")), allowMissingColumns=True)
    # Orders come before their lines; a key that several orders have gives its lines once for each.
    sorting = Window.partitionBy("l_orderkey").orderBy("is_line", "l_partkey", "l_quantity", "l_extendedprice")
    met = both.repartitionByRange("l_orderkey").withColumn("orders", F.collect_list("order").over(sorting.rowsBetween(Window.unboundedPreceding, 0)))
    joined = met.where("is_line = 1").withColumn("order", F.explode("orders"))
    return _as_text(joined.select("l_orderkey", *_LINE, "order.*"))


def _as_text(joined: DataFrame) -> DataFrame:
    """The texts of lines with their orders and products, a row per copy."""
    h = F.col("l_orderkey") * 31 + F.col("l_partkey") * 7 + F.col("l_linenumber")

    def every(n: int) -> Column:
        return h % n == 0

    day = F.col("o_orderdate").cast("date")
    empty = F.lit("")
    kinds = F.create_map(*[F.lit(x) for pair in CATEGORY_OF_TYPE.items() for x in pair])
    category = F.try_element_at(kinds, F.col("p_type"))
    typo = (
        F.when(category == "Electronics", _one_of(h % 2, F.lit("Electronic"), F.lit("electronics ")))
        .when(category == "Beauty", _one_of(h % 2, F.lit("Beauty & Personal Care"), F.lit("beauty")))
        .otherwise(category)
    )
    product = F.concat_ws(" ", "p_name", F.col("l_partkey").cast("string"))
    price = F.col("p_retailprice").cast("decimal(14,2)")
    lines = joined.select(
        F.concat(F.lit("ORD"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.when(every(101), F.lit("31/02/2024"))
        .otherwise(_one_of(h % 4, *[F.date_format(day, p) for p in ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy", "dd-MMM-yyyy")]))
        .alias("order_date"),
        F.concat(F.lit("CUST"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.when(every(25), empty)
        .when(every(19), F.concat(F.lit("  "), "c_name", F.lit("  ")))
        .otherwise(F.col("c_name"))
        .alias("customer_name"),
        F.when(every(8), empty)
        .otherwise(_one_of(h % 3, F.lower("r_name"), F.concat(F.lit(" "), "r_name"), F.concat("r_name", F.lit(" "))))
        .alias("region"),
        F.when(every(49), F.upper(product)).otherwise(product).alias("product_name"),
        F.when(every(7), typo).otherwise(category).alias("category"),
        F.when(every(97), _one_of(h % 3, F.lit("-1"), F.lit("0"), F.lit("abc")))
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        F.when(every(127), F.lit("0"))
        .when(every(199), (price * 100).cast("decimal(14,2)").cast("string"))
        .otherwise(price.cast("string"))
        .alias("unit_price"),
        F.when(every(10), empty)
        .otherwise(F.round(F.col("l_discount") * 100).cast("int").cast("string"))
        .alias("discount_percent"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(F.col("l_linestatus") == "O", "Online").otherwise("In-Store").alias("sales_channel"),
        F.explode(F.when(every(33), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
    )
    position = F.struct("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "copy").alias(ORDINAL)
    return lines.select(*lines.columns[:12], position)
