"""SQL for each registered query, written from the semantics alone, for an engine other than Spark."""

from __future__ import annotations

# Common table expressions, in the order they build on each other.
CTES = {
    "base": """
        SELECT *, l_orderkey * 31 + l_partkey * 7 + l_linenumber AS h, CAST(o_orderdate AS DATE) AS d,
               p_name || ' ' || CAST(p_partkey AS VARCHAR) AS product,
               CASE p_type WHEN 'ECONOMY' THEN 'Electronics' WHEN 'MEDIUM' THEN 'Apparel'
                           WHEN 'LARGE' THEN 'Home & Kitchen' WHEN 'PROMO' THEN 'Beauty'
                           WHEN 'SMALL' THEN 'Sports' WHEN 'STANDARD' THEN 'Standard' END AS kind
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        JOIN part ON l_partkey = p_partkey""",
    "copies": """
        SELECT *, 0 AS copy FROM base UNION ALL SELECT *, 1 AS copy FROM base WHERE h % 33 = 0""",
    "feed": """
        SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_quantity, l_extendedprice, copy) AS ord,
               'ORD' || CAST(l_orderkey AS VARCHAR) AS order_id,
               CASE WHEN h % 101 = 0 THEN '31/02/2024'
                    WHEN h % 4 = 0 THEN strftime(d, '%Y-%m-%d')
                    WHEN h % 4 = 1 THEN strftime(d, '%d/%m/%Y')
                    WHEN h % 4 = 2 THEN strftime(d, '%m-%d-%Y')
                    ELSE strftime(d, '%d-%b-%Y') END AS order_date,
               'CUST' || CAST(c_custkey AS VARCHAR) AS customer_id,
               CASE WHEN h % 25 = 0 THEN '' WHEN h % 19 = 0 THEN '  ' || c_name || '  ' ELSE c_name END AS customer_name,
               CASE WHEN h % 8 = 0 THEN '' WHEN h % 3 = 0 THEN lower(r_name)
                    WHEN h % 3 = 1 THEN ' ' || r_name ELSE r_name || ' ' END AS region,
               CASE WHEN h % 49 = 0 THEN upper(product) ELSE product END AS product_name,
               CASE WHEN h % 7 = 0 AND kind = 'Electronics'
                        THEN CASE WHEN h % 2 = 0 THEN 'Electronic' ELSE 'electronics ' END
                    WHEN h % 7 = 0 AND kind = 'Beauty'
                        THEN CASE WHEN h % 2 = 0 THEN 'Beauty & Personal Care' ELSE 'beauty' END
                    ELSE kind END AS category,
               CASE WHEN h % 97 = 0 THEN CASE h % 3 WHEN 0 THEN '-1' WHEN 1 THEN '0' ELSE 'abc' END
                    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
               CASE WHEN h % 127 = 0 THEN '0'
                    WHEN h % 199 = 0 THEN CAST(CAST(CAST(p_retailprice AS DECIMAL(14,2)) * 100 AS DECIMAL(14,2)) AS VARCHAR)
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS VARCHAR) END AS unit_price,
               CASE WHEN h % 10 = 0 THEN '' ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) END
                    AS discount_percent,
               o_orderpriority AS payment_method,
               CASE WHEN l_linestatus = 'O' THEN 'Online' ELSE 'In-Store' END AS sales_channel
        FROM copies""",
    "cells": """
        SELECT ord, order_id, order_date, customer_id,
               nullif(trim(customer_name), '') AS customer_name, nullif(trim(region), '') AS region,
               nullif(trim(product_name), '') AS product_name, nullif(trim(category), '') AS category,
               nullif(quantity, '') AS quantity, nullif(unit_price, '') AS unit_price,
               nullif(discount_percent, '') AS discount_percent, payment_method, sales_channel
        FROM feed""",
    "titled": """
        SELECT * REPLACE ({title_region} AS region, {title_product} AS product_name, {title_category} AS category)
        FROM cells""",
    "typed": """
        SELECT * REPLACE (
            CAST(coalesce(try_strptime(order_date, '%Y-%m-%d'), try_strptime(order_date, '%d/%m/%Y'),
                          try_strptime(order_date, '%m-%d-%Y'), try_strptime(order_date, '%d-%b-%Y')) AS DATE) AS order_date,
            CASE category WHEN 'Electronic' THEN 'Electronics' WHEN 'Beauty & Personal Care' THEN 'Beauty'
                          ELSE category END AS category,
            TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(unit_price AS DOUBLE) AS unit_price,
            coalesce(TRY_CAST(discount_percent AS DOUBLE), 0.0) AS discount_percent)
        FROM titled""",
    "valid": """
        SELECT * REPLACE (coalesce(customer_name, 'Unknown Customer') AS customer_name,
                          coalesce(region, 'Unspecified') AS region)
        FROM typed WHERE order_date IS NOT NULL AND quantity > 0 AND unit_price > 0""",
    "medians": """
        SELECT category, median(unit_price) AS med, count(*) AS n_values
        FROM valid WHERE category IS NOT NULL GROUP BY category""",
    "capped": """
        SELECT v.* REPLACE (CASE WHEN unit_price > 5 * med THEN round_even(med * 100, 0) / 100 ELSE unit_price END AS unit_price)
        FROM valid v LEFT JOIN medians m ON v.category = m.category""",
    "deduped": """
        SELECT * FROM capped
        QUALIFY row_number() OVER (PARTITION BY order_id, customer_id, product_name, order_date, quantity, unit_price
                                   ORDER BY ord) = 1""",
    "gross": "SELECT *, round_even(quantity * unit_price * 100, 0) / 100 AS gross_amount FROM {source}",
    "net": """
        SELECT *, round_even((gross_amount - discount_amount) * 100, 0) / 100 AS net_amount,
               CASE category WHEN 'Electronics' THEN 0.68::DOUBLE WHEN 'Apparel' THEN 0.55::DOUBLE
                             WHEN 'Home & Kitchen' THEN 0.62::DOUBLE WHEN 'Beauty' THEN 0.5::DOUBLE
                             WHEN 'Sports' THEN 0.58::DOUBLE ELSE 0.6::DOUBLE END AS cost_ratio
        FROM (SELECT *, round_even(gross_amount * discount_percent / 100 * 100, 0) / 100 AS discount_amount FROM gross)""",
    "amounts": """
        SELECT *, round_even((net_amount - cost_amount) * 100, 0) / 100 AS profit_amount
        FROM (SELECT *, round_even(gross_amount * cost_ratio * 100, 0) / 100 AS cost_amount FROM net)""",
    "clean": "SELECT *, row_number() OVER (ORDER BY ord) AS line_no FROM amounts",
    "customers": """
        SELECT row_number() OVER (ORDER BY line_no) AS customer_key, customer_id, customer_name FROM (
            SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY line_no) = 1)""",
    "products": """
        SELECT row_number() OVER (ORDER BY line_no) AS product_key, product_name, category FROM (
            SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY line_no) = 1)""",
    "regions": """
        SELECT row_number() OVER (ORDER BY line_no) AS region_key, region AS region_name FROM (
            SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY region ORDER BY line_no) = 1)""",
    "days": """
        SELECT CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, order_date AS full_date,
               year(order_date) AS year, quarter(order_date) AS quarter, month(order_date) AS month,
               monthname(order_date) AS month_name, day(order_date) AS day, dayname(order_date) AS weekday_name
        FROM (SELECT DISTINCT order_date FROM clean)""",
    "fact": """
        SELECT line_no AS sale_key, order_id, customer_key, product_key, region_key,
               CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, payment_method, sales_channel,
               CAST(trunc(quantity) AS BIGINT) AS quantity, CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
               CAST(discount_percent AS DECIMAL(5,2)) AS discount_percent,
               CAST(gross_amount AS DECIMAL(14,2)) AS gross_amount,
               CAST(discount_amount AS DECIMAL(14,2)) AS discount_amount,
               CAST(net_amount AS DECIMAL(14,2)) AS net_amount, CAST(cost_amount AS DECIMAL(14,2)) AS cost_amount,
               CAST(profit_amount AS DECIMAL(14,2)) AS profit_amount
        FROM clean LEFT JOIN customers USING (customer_id) LEFT JOIN products USING (product_name)
        LEFT JOIN regions ON region = region_name""",
}


def _title(column: str) -> str:
    words = f"regexp_extract_all({column}, '[A-Za-z]+|[^A-Za-z]+')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), '')"


CTES["titled"] = CTES["titled"].format(
    title_region=_title("region"), title_product=_title("product_name"), title_category=_title("category")
)

# What each table expression reads directly.
READS = {
    "base": [], "copies": ["base"], "feed": ["copies"], "cells": ["feed"], "titled": ["cells"], "typed": ["titled"],
    "valid": ["typed"], "medians": ["valid"], "capped": ["medians"], "deduped": ["capped"], "gross": ["deduped"],
    "net": ["gross"], "amounts": ["net"], "clean": ["amounts"], "customers": ["clean"], "products": ["clean"],
    "regions": ["clean"], "days": ["clean"], "fact": ["customers", "products", "regions"],
}


# A first feed of the first two thirds of the orders and a second one of the last two thirds, each with its medians.
APPENDED = """
    WITH parts AS (
        SELECT 0 AS part, * FROM valid WHERE CAST(substr(order_id, 4) AS BIGINT) * 3 <= 2 * (SELECT max(l_orderkey) FROM copies)
        UNION ALL
        SELECT 1, * FROM valid WHERE CAST(substr(order_id, 4) AS BIGINT) * 3 > (SELECT max(l_orderkey) FROM copies)),
    levels AS (
        SELECT 0 AS part, category, median(unit_price) AS med FROM parts WHERE part = 0 AND category IS NOT NULL GROUP BY category
        UNION ALL SELECT 1, category, median(unit_price) FROM parts WHERE category IS NOT NULL GROUP BY category)
    SELECT p.* EXCLUDE (part) REPLACE (
        CASE WHEN unit_price > 5 * med THEN round_even(med * 100, 0) / 100 ELSE unit_price END AS unit_price,
        p.part * 1000000000000 + ord AS ord)
    FROM parts p LEFT JOIN levels l ON p.part = l.part AND p.category = l.category"""


def query(select: str, *reads: str, source: str = "deduped", capped: str | None = None) -> str:
    """``select`` over the named table expressions and all they build on."""
    needed: list[str] = []

    def need(name: str) -> None:
        if name not in needed:
            for other in READS[name]:
                need(other)
            needed.append(name)

    for name in reads:
        need(name)
    # Computed once each, since many of them are read several times.
    texts = CTES | ({"capped": capped} if capped else {})
    parts = ",\n".join(f"{n} AS MATERIALIZED ({texts[n].replace('{source}', source)})" for n in needed)
    return f"WITH {parts}\n{select}"


def money(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) + 0.0 AS {c}" for c in columns)


def half_up_percent(part: str, whole: str) -> str:
    """100 * part / whole to two places, half away from zero, on whole cents."""
    p, w = f"CAST(({part}) * 100 AS HUGEINT)", f"CAST(({whole}) * 100 AS HUGEINT)"
    magnitude = f"((2 * 10000 * abs({p}) + abs({w})) // nullif(2 * abs({w}), 0))"
    return f"CAST(sign({p}) * sign({w}) * {magnitude} AS DOUBLE) / 100"


def half_up_mean(total: str, n: str) -> str:
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    return f"CAST(sign({cents}) * ((2 * abs({cents}) + {n}) // nullif(2 * {n}, 0)) AS DOUBLE) / 100"


AMOUNTS = ["gross_amount", "discount_amount", "net_amount", "cost_amount", "profit_amount"]
TYPED = """order_id, CAST(order_date AS VARCHAR) AS order_date, customer_id, customer_name, region, product_name, category,
           quantity, unit_price, discount_percent, payment_method, sales_channel"""
DAYS = """date_key, CAST(full_date AS VARCHAR) AS full_date, CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter,
          CAST(month AS BIGINT) AS month, month_name, CAST(day AS BIGINT) AS day, weekday_name"""
FLAT = f"""sale_key, order_id, CAST(full_date AS VARCHAR) AS full_date, CAST(year AS BIGINT) AS year,
           CAST(quarter AS BIGINT) AS quarter, month_name, weekday_name, customer_id, customer_name, product_name, category,
           region_name, payment_method, sales_channel, quantity,
           {money('unit_price', 'discount_percent', *AMOUNTS)}
           FROM fact JOIN days USING (date_key) JOIN customers USING (customer_key) JOIN products USING (product_key)
           JOIN regions USING (region_key)"""

SALES = f"""SELECT sale_key, order_id, customer_key, product_key, region_key, date_key, payment_method, sales_channel,
           quantity, {money('unit_price', 'discount_percent', *AMOUNTS)} FROM fact"""
MONTHS = f"""SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, month_name, orders,
           CAST(total AS DOUBLE) AS revenue, CAST(gain AS DOUBLE) AS profit, {half_up_mean('total', 'n')} AS avg_order_value
    FROM (SELECT year, month, month_name, count(DISTINCT order_id) AS orders, sum(net_amount) AS total,
                 sum(profit_amount) AS gain, count(*) AS n
          FROM fact JOIN days USING (date_key) GROUP BY year, month, month_name)"""

METRICS = """
    SELECT position, metric, CAST(value AS BIGINT) AS value FROM (
        SELECT 1 AS position, 'input_rows' AS metric, (SELECT count(*) FROM typed) AS value
        UNION ALL SELECT 2, 'invalid_dates', (SELECT count(*) FROM typed WHERE order_date IS NULL)
        UNION ALL SELECT 3, 'missing_customer_name', (SELECT count(*) FROM typed WHERE customer_name IS NULL)
        UNION ALL SELECT 4, 'missing_region', (SELECT count(*) FROM typed WHERE region IS NULL)
        UNION ALL SELECT 5, 'missing_quantity', (SELECT count(*) FROM typed WHERE quantity IS NULL)
        UNION ALL SELECT 6, 'missing_unit_price', (SELECT count(*) FROM typed WHERE unit_price IS NULL)
        UNION ALL SELECT 7, 'rows_dropped_invalid', (SELECT count(*) FROM typed) - (SELECT count(*) FROM valid)
        UNION ALL SELECT 8, 'price_outliers_capped',
            (SELECT count(*) FROM valid v JOIN medians m ON v.category = m.category WHERE v.unit_price > 5 * med)
        UNION ALL SELECT 9, 'duplicate_rows_removed', (SELECT count(*) FROM capped) - (SELECT count(*) FROM deduped)
        UNION ALL SELECT 10, 'output_rows', (SELECT count(*) FROM deduped))"""
COUNTS = """
    SELECT position, metric, CAST(value AS BIGINT) AS value FROM (
        SELECT 1 AS position, 'dim_customer' AS metric, (SELECT count(*) FROM customers) AS value
        UNION ALL SELECT 2, 'dim_product', (SELECT count(*) FROM products)
        UNION ALL SELECT 3, 'dim_region', (SELECT count(*) FROM regions)
        UNION ALL SELECT 4, 'dim_date', (SELECT count(*) FROM days)
        UNION ALL SELECT 5, 'fact_sales', (SELECT count(*) FROM fact))"""
REPORT = f"""
    SELECT * FROM (VALUES
        (CAST(0 AS BIGINT), CAST(1 AS BIGINT), 'RETAIL SALES PIPELINE — DATA QUALITY REPORT'),
        (0, 2, repeat('=', 50)), (0, 3, ''), (1, 0, '-- Transform stage findings --'),
        (2, -1, ''), (2, 0, '-- Final row counts loaded into warehouse --')) AS t(section, position, line)
    UNION ALL SELECT 1, position, rpad(metric, 30, ' ') || ': ' || CAST(value AS VARCHAR) FROM ({METRICS})
    UNION ALL SELECT 2, position, rpad(metric, 30, ' ') || ': ' || CAST(value AS VARCHAR) FROM ({COUNTS})"""
CHECKS = """
    SELECT CAST(position AS BIGINT) AS position, check_name, CAST(violations AS BIGINT) AS violations,
           CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (
        SELECT 1 AS position, 'No NULL customer keys in fact_sales' AS check_name,
               (SELECT count(*) FROM fact WHERE customer_key IS NULL) AS violations
        UNION ALL SELECT 2, 'No NULL product keys in fact_sales', (SELECT count(*) FROM fact WHERE product_key IS NULL)
        UNION ALL SELECT 3, 'No negative or zero quantity', (SELECT count(*) FROM fact WHERE quantity <= 0)
        UNION ALL SELECT 4, 'No negative or zero unit_price', (SELECT count(*) FROM fact WHERE unit_price <= 0)
        UNION ALL SELECT 5, 'No net_amount mismatched with gross - discount',
            (SELECT count(*) FROM fact WHERE abs(net_amount - (gross_amount - discount_amount)) > 0.01)
        UNION ALL SELECT 6, 'No duplicate (order_id, product_key, date_key) lines', (SELECT count(*) FROM (
            SELECT 1 FROM fact GROUP BY order_id, product_key, date_key HAVING count(*) > 1))
        UNION ALL SELECT 7, 'Every fact row''s customer_key exists in dim_customer', (SELECT count(*) FROM fact f
            WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_key = f.customer_key))
        UNION ALL SELECT 8, 'Every fact row''s product_key exists in dim_product', (SELECT count(*) FROM fact f
            WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_key = f.product_key)))"""

_TABLES = {
    "dim_customer": ("customers", ["customer_key", "customer_id", "customer_name"], ["customer_key", "customer_id"]),
    "dim_product": ("products", ["product_key", "product_name", "category"], ["product_key", "product_name"]),
    "dim_region": ("regions", ["region_key", "region_name"], ["region_key", "region_name"]),
    "dim_date": ("days", ["date_key", "full_date", "year", "quarter", "month", "month_name", "day", "weekday_name"],
                 ["date_key"]),
    "fact_sales": ("fact", ["sale_key", "order_id", "customer_key", "product_key", "region_key", "date_key", "quantity",
                            "unit_price", "discount_percent", *AMOUNTS], ["sale_key"]),
}


def _constraints() -> str:
    rules: list[tuple[str, str]] = []
    for table, (cte, columns, keys) in _TABLES.items():
        rules += [(f"{table}: {c} not null", f"SELECT count(*) FROM {cte} WHERE {c} IS NULL") for c in columns]
        if table == "fact_sales":
            rules += [(f"{table}: {c} > 0", f"SELECT count(*) FROM fact WHERE {c} <= 0") for c in ("quantity", "unit_price")]
        rules += [(f"{table}: {k} unique", f"SELECT count({k}) - count(DISTINCT {k}) FROM {cte}") for k in keys]
    for key, table in (("customer_key", "dim_customer"), ("product_key", "dim_product"), ("region_key", "dim_region"),
                       ("date_key", "dim_date")):
        cte = _TABLES[table][0]
        rules.append((f"fact_sales: {key} in {table}",
                      f"SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {cte} x WHERE x.{key} = f.{key})"))
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS check_name, ({sql}) AS violations" for i, (name, sql) in enumerate(rules, 1)
    )
    return f"""SELECT CAST(position AS BIGINT) AS position, check_name, CAST(violations AS BIGINT) AS violations,
        CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({rows})"""


PER_CUSTOMER = """
    SELECT customer_id, customer_name, count(DISTINCT order_id) AS order_count, sum(net_amount) AS ltv,
           max(full_date) AS last_date
    FROM fact JOIN customers USING (customer_key) JOIN days USING (date_key) GROUP BY customer_id, customer_name"""

SEGMENTS = f"""
    SELECT customer_id, customer_name, order_count, CAST(ltv AS DOUBLE) AS lifetime_value,
           CAST(last_date AS VARCHAR) AS last_purchase_date,
           CASE WHEN order_count = 1 THEN 'One-time' WHEN order_count BETWEEN 2 AND 4 THEN 'Occasional'
                ELSE 'Loyal' END AS customer_segment
    FROM ({PER_CUSTOMER})"""

ORACLES: dict[str, str] = {
    "null_tokens": query("SELECT order_id, customer_name, region, category, discount_percent FROM cells", "cells"),
    "title_case": query("SELECT order_id, region, product_name, category FROM titled", "titled"),
    "canonical_category": query("SELECT order_id, category FROM typed", "typed"),
    "impute_defaults": query(
        """SELECT order_id, coalesce(customer_name, 'Unknown Customer') AS customer_name,
                  coalesce(region, 'Unspecified') AS region FROM typed""", "typed"),
    "parse_dates": query(
        """SELECT t.order_id, f.order_date AS text, CAST(t.order_date AS VARCHAR) AS order_date
           FROM typed t JOIN feed f USING (ord)""", "typed"),
    "date_attributes": query(
        f"""SELECT order_id, {DAYS} FROM (
               SELECT order_id, CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, order_date AS full_date,
                      year(order_date) AS year, (month(order_date) - 1) // 3 + 1 AS quarter, month(order_date) AS month,
                      strftime(order_date, '%B') AS month_name, day(order_date) AS day,
                      strftime(order_date, '%A') AS weekday_name
               FROM typed WHERE order_date IS NOT NULL)""", "typed"),
    "coerce_numbers": query("SELECT order_id, quantity, unit_price, discount_percent FROM typed", "typed"),
    "derive_amounts": query(
        f"""SELECT order_id, category, quantity, unit_price, discount_percent, cost_ratio, {money(*AMOUNTS)} FROM amounts""",
        "valid", "amounts", source="valid"),
    "drop_invalid": query(
        f"SELECT {TYPED} FROM typed WHERE order_date IS NOT NULL AND quantity > 0 AND unit_price > 0", "typed"),
    "line_profile": query(
        """SELECT category, price, count(*) AS n_lines, CAST(sum(ok) AS BIGINT) AS n_valid,
                  count(*) - count(order_date) AS n_invalid_date, count(*) - count(customer_name) AS n_no_name,
                  count(*) - count(region) AS n_no_region, count(*) - count(quantity) AS n_no_quantity,
                  count(*) - count(unit_price) AS n_no_price
           FROM (SELECT *, CASE WHEN order_date IS NOT NULL AND quantity > 0 AND unit_price > 0 THEN 1 ELSE 0 END AS ok,
                        CASE WHEN ok = 1 THEN unit_price END AS price FROM typed)
           GROUP BY category, price""", "typed"),
    "category_median": query("SELECT category, med AS median, n_values FROM medians", "medians"),
    "cap_outliers": query("SELECT order_id, product_name, category, quantity, unit_price FROM capped", "capped"),
    "dedup_lines": query(
        f"""SELECT {TYPED} FROM (
               SELECT d.* REPLACE (t.customer_name AS customer_name, t.region AS region)
               FROM deduped d JOIN typed t USING (ord))""", "deduped"),
    "clean_sales": query(f"SELECT {TYPED}, cost_ratio, {money(*AMOUNTS)}, line_no FROM clean", "clean"),
    "feed_csv": query(
        """SELECT order_id, order_date, customer_id, nullif(customer_name, '') AS customer_name, nullif(region, '') AS region,
                  product_name, category, quantity, unit_price, nullif(discount_percent, '') AS discount_percent,
                  payment_method, sales_channel, ord AS input_line FROM feed""", "feed"),
    "feed_csv_breaks": query(
        """SELECT order_id, CASE WHEN CAST(substr(order_id, 4) AS BIGINT) % 5 = 0 THEN product_name || ',' || chr(10) || '"' || order_id
                                 ELSE product_name END AS product_name, quantity, sales_channel,
                  row_number() OVER (PARTITION BY order_id ORDER BY ord) AS line_of_order FROM feed""", "feed"),
    "clean_csv": query(f"SELECT {TYPED}, cost_ratio, {money(*AMOUNTS)} FROM clean", "clean"),
    "dim_customer": query("SELECT customer_key, customer_id, customer_name FROM customers", "customers"),
    "dim_product": query("SELECT product_key, product_name, category FROM products", "products"),
    "dim_region": query("SELECT region_key, region_name FROM regions", "regions"),
    "dim_date": query(f"SELECT {DAYS} FROM days", "days"),
    "fact_sales": query(SALES, "fact"),
    "monthly_revenue": query(
        f"""SELECT year, month_name, CAST(revenue AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS prev_month_revenue,
                   {half_up_percent('revenue - prev', 'prev')} AS mom_growth_percent
            FROM (SELECT *, lag(revenue) OVER (ORDER BY year, month) AS prev FROM (
                SELECT CAST(year AS BIGINT) AS year, month, month_name, sum(net_amount) AS revenue
                FROM fact JOIN days USING (date_key) GROUP BY ALL))""", "fact", "days"),
    "category_profit": query(
        f"""SELECT category, CAST(revenue AS DOUBLE) AS total_revenue, CAST(profit AS DOUBLE) AS total_profit,
                   {half_up_percent('profit', 'revenue')} AS profit_margin_percent,
                   rank() OVER (ORDER BY profit DESC) AS profit_rank
            FROM (SELECT category, sum(net_amount) AS revenue, sum(profit_amount) AS profit
                  FROM fact JOIN products USING (product_key) GROUP BY category)""", "fact"),
    "top_product": query(
        """SELECT category, product_name, CAST(revenue AS DOUBLE) AS revenue, CAST(units AS BIGINT) AS units_sold
           FROM (SELECT category, product_name, sum(net_amount) AS revenue, sum(quantity) AS units
                 FROM fact JOIN products USING (product_key) GROUP BY ALL)
           QUALIFY row_number() OVER (PARTITION BY category ORDER BY revenue DESC, product_name) = 1""", "fact"),
    "region_share": query(
        f"""SELECT region_name, orders AS total_orders, CAST(revenue AS DOUBLE) AS total_revenue,
                   {half_up_mean('revenue', 'n')} AS avg_order_value,
                   {half_up_percent('revenue', 'whole')} AS pct_of_total_revenue
            FROM (SELECT *, sum(revenue) OVER () AS whole FROM (
                SELECT region_name, count(DISTINCT order_id) AS orders, sum(net_amount) AS revenue, count(*) AS n
                FROM fact JOIN regions USING (region_key) GROUP BY region_name))""", "fact"),
    "customer_segments": query(SEGMENTS, "fact", "days"),
    "top_customers": query(f"{SEGMENTS} ORDER BY ltv DESC, customer_id LIMIT 5", "fact", "days"),
    "repeat_share": query(
        f"""SELECT CAST(sum(CASE WHEN order_count > 1 THEN 1 ELSE 0 END) AS DOUBLE) * 100.0::DOUBLE / count(*)
                       AS pct_repeat_customers,
                   CAST(sum(CASE WHEN order_count > 1 THEN ltv ELSE 0 END) AS DOUBLE) * 100.0::DOUBLE
                       / CAST(sum(ltv) AS DOUBLE) AS pct_revenue_from_repeat
            FROM ({PER_CUSTOMER})""", "fact", "days"),
    "sales_flat": query(f"SELECT {FLAT}", "fact", "days"),
    "monthly_kpis": query(MONTHS, "fact", "days"),
    "flat_csv": query(f"SELECT {FLAT}", "fact", "days"),
    "dq_metrics": query(METRICS.replace("SELECT position", "SELECT CAST(position AS BIGINT) AS position", 1), "deduped"),
    "load_counts": query(COUNTS.replace("SELECT position", "SELECT CAST(position AS BIGINT) AS position", 1), "fact", "days"),
    "dq_report": query(REPORT, "fact", "days"),
    "warehouse_checks": query(CHECKS, "fact"),
    "constraint_checks": query(_constraints(), "fact", "days"),
    "orphan_keys": query(
        """SELECT product_key, count(*) AS n_lines FROM fact JOIN products USING (product_key)
           WHERE category NOT IN ('Electronics', 'Apparel', 'Home & Kitchen', 'Beauty', 'Sports') GROUP BY product_key""",
        "fact"),
    "duplicate_groups": query(
        """SELECT order_id, product_key, date_key, count(*) AS n_lines FROM fact
           GROUP BY order_id, product_key, date_key HAVING count(*) > 1""", "fact"),
}
ORACLES["category_profit_by_range"] = ORACLES["category_profit"]
ORACLES |= {
    "append_fact": query(SALES, "fact", capped=APPENDED),
    "append_flat": query(f"SELECT {FLAT}", "fact", "days", capped=APPENDED),
    "append_monthly": query(MONTHS, "fact", "days", capped=APPENDED),
    "append_counts": query(COUNTS.replace("SELECT position", "SELECT CAST(position AS BIGINT) AS position", 1), "fact", "days", capped=APPENDED),
}
