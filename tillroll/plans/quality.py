"""Quality counts, warehouse checks and table constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.lookup import lookup
from tillroll.plans.cleaning import Cleaned, is_outlier
from tillroll.sources.schemas import FOREIGN_KEYS, NOT_NULL, UNIQUE, WAREHOUSE_TABLES
from tillroll.sources.warehouse import Warehouse

# Names and order of the metrics in the report.
METRICS = [
    "input_rows", "invalid_dates", "missing_customer_name", "missing_region", "missing_quantity",
    "missing_unit_price", "rows_dropped_invalid", "price_outliers_capped", "duplicate_rows_removed",
    "output_rows",
]
# Names of the warehouse checks.
V1 = "No NULL customer keys in fact_sales"
V2 = "No NULL product keys in fact_sales"
V3 = "No negative or zero quantity"
V4 = "No negative or zero unit_price"
V5 = "No net_amount mismatched with gross - discount"
V6 = "No duplicate (order_id, product_key, date_key) lines"
V7 = "Every fact row's customer_key exists in dim_customer"
V8 = "Every fact row's product_key exists in dim_product"
CHECKS = [V1, V2, V3, V4, V5, V6, V7, V8]


class QualityError(Exception):
    """A load broke table constraints, or a warehouse failed its checks."""


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _text(value: str) -> str:
    """SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _texts(values: list[str]) -> str:
    return ", ".join(map(_text, values))


def _totals(df: DataFrame, sums: dict[str, str], name: str, value: str) -> DataFrame:
    """One pass over ``df``: the total of each SQL expression, as rows of (name, value)."""
    totals = df.agg(*[F.expr(f"coalesce(sum(CAST({x} AS BIGINT)), 0L) AS `{label}`") for label, x in sums.items()])
    entries = ", ".join(f"{_text(label)}, `{label}`" for label in sums)
    return totals.selectExpr(f"stack({len(sums)}, {entries}) AS ({name}, {value})")


def _position(names: list[str], column: str) -> Column:
    return F.expr(f"CAST(array_position(array({_texts(names)}), {column}) AS INT) AS position")


def dq_metrics(cleaned: Cleaned) -> DataFrame:
    """M1-M8 as (position, metric, value). Differences are sums of signed parts, so nothing is collected."""
    counted = _totals(cleaned.profile, {
        "input_rows": "n_lines",
        "invalid_dates": "n_invalid_date",
        "missing_customer_name": "n_no_name",
        "missing_region": "n_no_region",
        "missing_quantity": "n_no_quantity",
        "missing_unit_price": "n_no_price",
        "rows_dropped_invalid": "n_lines - n_valid",
        "duplicate_rows_removed": "n_valid",
    }, "metric", "part")
    known = lookup(cleaned.profile, cleaned.medians, "category", how="inner", weight="n_values")
    outliers = known.where(is_outlier(F.col("price"), F.col("median")))
    capped = _totals(outliers, {"price_outliers_capped": "n_valid"}, "metric", "part")
    kept = _totals(cleaned.lines, {"output_rows": "1", "duplicate_rows_removed": "-1"}, "metric", "part")
    values = _union([counted, capped, kept]).groupBy("metric").agg(F.sum("part").alias("value"))
    return values.select(_position(METRICS, "metric"), "metric", "value")


def load_counts(warehouse: Warehouse) -> DataFrame:
    """M9 as (position, metric, value)."""
    return _union([
        warehouse[name].agg(F.count("*").alias("value")).select(
            F.lit(i).alias("position"), F.lit(name).alias("metric"), "value"
        )
        for i, name in enumerate(WAREHOUSE_TABLES, 1)
    ])


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """U4 and K3: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_lines")).where(F.col("n_lines") > 1)


def is_gapless(df: DataFrame, key: str) -> bool:
    """K3: whether the keys that aren't null are low, low + 1, ..., high, each once; false is no proof of the contrary.

    No row is shuffled. With as many rows as numbers between the bounds, the keys are a gapless run exactly if every number
    occurs an odd number of times, and that shows in the exclusive or of 128 bits of hash per key, against that of the run
    itself. Two that differ agree with probability 2^-128.
    """
    hashes = [F.bit_xor(F.xxhash64(*seed, F.col(key).cast("bigint"))).alias(f"h{i}") for i, seed in enumerate(([], [F.lit(1)]))]
    found = df.where(F.col(key).isNotNull()).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"), *hashes).first()
    if not found.n:
        return True
    if found.n != found.high - found.low + 1:
        return False
    run = df.sparkSession.range(found.low, found.high + 1).withColumnRenamed("id", key).agg(*hashes).first()
    return (run.h0, run.h1) == (found.h0, found.h1)


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keys of the fact that the dimension lacks (null included), with their line count.

    The fact is reduced to its keys before the join, so a hot key is one row.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("n_lines"))
    return per_key.join(dim.select(key), key, "left_anti")


def _orphan_counts(warehouse: Warehouse, names: dict[str, str], rules: dict[str, str]) -> list[DataFrame]:
    """Orphaned lines per foreign key (V7, V8, K4), and totals of further ``rules``, as (check_name, violations).

    ``names`` maps foreign keys to check names. Where a dimension's keys are 1 to n, bounds decide, in the one scan of the
    fact that the rules take anyway; keys of others are counted and looked for, a row per key. A key without orphans may
    have no row.
    """
    sparse = {}
    for key, name in names.items():
        n = warehouse.dense_keys(FOREIGN_KEYS[key], key)
        if n is None:
            sparse[key] = name
        else:
            rules = rules | {name: f"NOT coalesce({key} BETWEEN 1 AND {n}, false)"}
    counts = [_totals(warehouse["fact_sales"], rules, "check_name", "violations")] if rules else []
    if sparse:
        entries = ", ".join(f"{_text(name)}, {key}" for key, name in sparse.items())
        used = warehouse["fact_sales"].selectExpr(f"stack({len(sparse)}, {entries}) AS (check_name, key)")
        per_key = used.groupBy("check_name", "key").agg(F.count("*").alias("violations"))
        known = _union([
            warehouse[FOREIGN_KEYS[key]].selectExpr(f"{_text(name)} AS check_name", f"{key} AS key")
            for key, name in sparse.items()
        ])
        counts.append(per_key.join(known, ["check_name", "key"], "left_anti").select("check_name", "violations"))
    return counts


def _status(counts: list[DataFrame], names: list[str]) -> DataFrame:
    """Violations per name, 0 for a name without any."""
    zeros = counts[0].sparkSession.range(1, numPartitions=1).selectExpr(
        f"explode(array({_texts(names)})) AS check_name", "0L AS violations"
    )
    totals = _union([*counts, zeros]).groupBy("check_name").agg(F.sum("violations").alias("violations"))
    status = F.expr("CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status")
    return totals.select(_position(names, "check_name"), "check_name", "violations", status)


def warehouse_checks(warehouse: Warehouse) -> DataFrame:
    """V1-V8 as (position, check_name, violations, status); V1-V5, and V7 and V8 where keys are dense, share a scan of the fact."""
    fact = warehouse["fact_sales"]
    rows = {
        V1: "customer_key IS NULL",
        V2: "product_key IS NULL",
        V3: "quantity <= 0",
        V4: "unit_price <= 0",
        V5: "abs(net_amount - (gross_amount - discount_amount)) > 0.01",
    }
    groups = duplicate_groups(fact, ["order_id", "product_key", "date_key"])
    repeated = _totals(groups, {V6: "1"}, "check_name", "violations")
    return _status([repeated, *_orphan_counts(warehouse, {"customer_key": V7, "product_key": V8}, rows)], CHECKS)


def constraint_checks(warehouse: Warehouse) -> DataFrame:
    """V9: what the table definitions demand (K1-K4), as (position, check_name, violations, status)."""
    counts, names, keys, fact_rules = [], [], [], {}
    for table, columns in NOT_NULL.items():
        rules = {f"{table}: {c} not null": f"{c} IS NULL" for c in columns}
        if table == "fact_sales":
            rules |= {f"{table}: {c} > 0": f"{c} <= 0" for c in ("quantity", "unit_price")}
        else:
            # The key as text, so that one pass serves all dimensions; the check's name tells them apart.
            entries = ", ".join(f"'{table}: {key} unique', CAST({key} AS STRING)" for key in UNIQUE[table])
            keys.append(warehouse[table].selectExpr(f"stack({len(UNIQUE[table])}, {entries}) AS (check_name, key)"))
        if table == "fact_sales":
            fact_rules = rules
        else:
            counts.append(_totals(warehouse[table], rules, "check_name", "violations"))
        names += [*rules, *[f"{table}: {key} unique" for key in UNIQUE[table]]]
    repeated = [duplicate_groups(_union(keys).where("key IS NOT NULL"), ["check_name", "key"])]
    # The fact's key goes alone and as a number, since it is the only one with a row per line; it is counted only where its
    # rows aren't numbered without gaps, as a load numbers them.
    for key in UNIQUE["fact_sales"]:
        if not is_gapless(warehouse["fact_sales"], key):
            groups = duplicate_groups(warehouse["fact_sales"].where(F.col(key).isNotNull()), [key])
            repeated.append(groups.selectExpr(f"'fact_sales: {key} unique' AS check_name", "n_lines"))
    counts += [groups.selectExpr("check_name", "n_lines - 1 AS violations") for groups in repeated]
    references = {key: f"fact_sales: {key} in {table}" for key, table in FOREIGN_KEYS.items()}
    counts += _orphan_counts(warehouse, references, fact_rules)
    return _status(counts, [*names, *references.values()])


def require_passed(checks: DataFrame) -> list:
    """The checks in order; raises when one failed. One row per check, so the collect is bounded."""
    rows = checks.orderBy("position").collect()
    failed = [r for r in rows if r.status == "FAIL"]
    if failed:
        details = "; ".join(f"{r.check_name} (violations: {r.violations})" for r in failed)
        raise QualityError(f"{len(rows) - len(failed)}/{len(rows)} checks passed. Failed: {details}")
    return rows
