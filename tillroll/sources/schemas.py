"""Column lists and types of the feed and of the warehouse. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = [
    "order_id", "order_date", "customer_id", "customer_name", "region", "product_name",
    "category", "quantity", "unit_price", "discount_percent", "payment_method", "sales_channel",
]
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# Position of a line in the feed; any orderable type, unique per line.
ORDINAL = "src_ordinal"

AMOUNT_COLUMNS = [
    "gross_amount", "discount_amount", "net_amount", "cost_ratio", "cost_amount", "profit_amount",
]
CLEAN_COLUMNS = RAW_COLUMNS + AMOUNT_COLUMNS

DIM_CUSTOMER = T.StructType([
    T.StructField("customer_key", T.IntegerType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
])
DIM_PRODUCT = T.StructType([
    T.StructField("product_key", T.IntegerType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
])
DIM_REGION = T.StructType([
    T.StructField("region_key", T.IntegerType()),
    T.StructField("region_name", T.StringType()),
])
DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("weekday_name", T.StringType()),
])
MONEY = T.DecimalType(14, 2)
FACT_SALES = T.StructType([
    T.StructField("sale_key", T.LongType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_key", T.IntegerType()),
    T.StructField("product_key", T.IntegerType()),
    T.StructField("region_key", T.IntegerType()),
    T.StructField("date_key", T.IntegerType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("sales_channel", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DecimalType(12, 2)),
    T.StructField("discount_percent", T.DecimalType(5, 2)),
    T.StructField("gross_amount", MONEY),
    T.StructField("discount_amount", MONEY),
    T.StructField("net_amount", MONEY),
    T.StructField("cost_amount", MONEY),
    T.StructField("profit_amount", MONEY),
])

WAREHOUSE_TABLES = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_region": DIM_REGION,
    "dim_date": DIM_DATE,
    "fact_sales": FACT_SALES,
}

# NOT NULL columns (K1); payment_method and sales_channel may be null.
NOT_NULL = {
    "dim_customer": ["customer_key", "customer_id", "customer_name"],
    "dim_product": ["product_key", "product_name", "category"],
    "dim_region": ["region_key", "region_name"],
    "dim_date": [f.name for f in DIM_DATE],
    "fact_sales": [f.name for f in FACT_SALES if f.name not in ("payment_method", "sales_channel")],
}
# Primary and natural keys (K3).
UNIQUE = {
    "dim_customer": ["customer_key", "customer_id"],
    "dim_product": ["product_key", "product_name"],
    "dim_region": ["region_key", "region_name"],
    "dim_date": ["date_key"],
    "fact_sales": ["sale_key"],
}
# Foreign keys of the fact (K4).
FOREIGN_KEYS = {
    "customer_key": "dim_customer",
    "product_key": "dim_product",
    "region_key": "dim_region",
    "date_key": "dim_date",
}
