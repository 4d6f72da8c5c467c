"""A further feed added to a published run, without touching the lines that are there.

The result is that of a load of all feeds, the older lines first, as far as the older lines' prices go unchanged:
published lines keep keys and amounts, copies of them among the new lines are dropped, natural keys that are known keep
their surrogate keys and names, and others continue the numbering. New outliers are told by the medians of all valid
lines so far. Where these medians would have capped an older line otherwise, a load of all would differ; the number of
such lines is counted, from the profiles alone.

Whole lines move only if they are new. Of the old rows are read: 16 bytes per line, which meet those of the new lines in one
shuffle to find copies, the key columns of dimensions, the profiles, and the months that the new lines fall into.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.numbers import round_cents
from tillroll.operators.firsts import first_values, key_hashes
from tillroll.operators.lookup import lookup
from tillroll.operators.ordering import SLOT, freeze_in_order, number_rows
from tillroll.operators.positions import bounded_broadcast, with_positions
from tillroll.operators.staging import Staging, side_by_side
from tillroll.plans.analytics import monthly_kpis
from tillroll.plans.cleaning import (
    DEDUP_KEYS, Cleaned, cap_outliers, category_medians, dedup_lines, drop_invalid, impute_defaults, is_outlier, profile_lines, typed_lines, write_clean,
)
from tillroll.plans.quality import constraint_checks, require_passed
from tillroll.plans.star import KEYED_LINES, dates, fact
from tillroll.sources.schemas import ORDINAL
from tillroll.sources.warehouse import (
    HOT_LINES, LINE_HASHES, MEDIANS, MONTHLY, PROFILE, SALE_YEAR, Warehouse, add_to_run, added_to, discard_run, hot_keys, last_published,
    publish, read_run, stored_parts, write_run,
)


@dataclass
class Appended:
    """``cleaned``: the new lines, as long as the staging folder is there; ``n_overtaken``: see above."""

    cleaned: Cleaned
    warehouse: Warehouse
    n_lines: int
    n_overtaken: int


def stored_state(cleaned: Cleaned) -> dict[str, DataFrame]:
    """What a run keeps for feeds to come."""
    return {PROFILE: cleaned.profile.drop(SLOT), MEDIANS: cleaned.medians, LINE_HASHES: cleaned.lines.select(*key_hashes(DEDUP_KEYS))}


def merged_profile(profiles: list[DataFrame], staging: Staging) -> DataFrame:
    """Counts per (category, price) over all feeds, frozen in that order."""
    every = reduce(DataFrame.unionByName, profiles)
    counts = [F.sum(c).alias(c) for c in every.columns if c not in ("category", "price")]
    return freeze_in_order(every.groupBy("category", "price").agg(*counts), ["category", "price"], staging, "merged_profile")


def overtaken(profiles: list[DataFrame], then: list[DataFrame], now: DataFrame) -> int:
    """Valid lines whose price the medians ``now`` would leave otherwise than those of their own feed did."""

    def left(median: str) -> Column:
        return F.when(is_outlier(F.col("price"), F.col(median)), round_cents(F.col(median))).otherwise(F.col("price"))

    parts = []
    for profile, medians in zip(profiles, then, strict=True):
        prices = profile.where(F.col("price").isNotNull()).select("category", "price", "n_valid")
        for name, table in (("then", medians), ("now", now)):
            prices = lookup(prices, table.withColumnRenamed("median", name), "category", weight="n_values")
        parts.append(prices.where(~left("then").eqNullSafe(left("now"))).agg(F.sum("n_valid").alias("n")))
    return reduce(DataFrame.union, parts).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def clean_further(typed: DataFrame, spark: SparkSession, root: str, base: str, n_base: int, staging: Staging) -> Cleaned:
    """P1 for the new lines; ``line_no`` goes on after the ``n_base`` lines there are."""
    profile = staging.write(profile_lines(typed), "profile")
    merged = merged_profile([*stored_parts(spark, root, base, PROFILE), profile], staging)
    medians = staging.write(category_medians(merged), "medians")
    valid = impute_defaults(drop_invalid(with_positions(typed, ORDINAL, staging)))
    published = reduce(DataFrame.unionByName, stored_parts(spark, root, base, LINE_HASHES))
    kept = dedup_lines(cap_outliers(valid, medians), staging, published).withColumn("line_no", F.col("line_no") + n_base)
    return Cleaned(write_clean(kept, typed, staging), profile, medians)


def further_members(
    clean: DataFrame, known: DataFrame, n_known: int, natural_key: str, payload: list[str], surrogate_key: str, staging: Staging
) -> tuple[DataFrame, DataFrame]:
    """The new rows of a dimension, numbered from ``n_known`` on by first appearance; and surrogate key and ``n_lines`` per
    natural key of the new lines, known or new."""
    members = staging.write(first_values(clean, natural_key, payload, "line_no", staging), f"members_{natural_key}")
    ours = bounded_broadcast(members.select(natural_key, "n_lines"))
    seen = staging.write(known.select(natural_key, surrogate_key).join(ours, natural_key), f"seen_{natural_key}")
    unseen = members.join(bounded_broadcast(seen.select(natural_key)), natural_key, "left_anti")
    numbered = number_rows(freeze_in_order(unseen, ["first_line"], staging, surrogate_key), surrogate_key)
    numbered = numbered.withColumn(surrogate_key, (F.col(surrogate_key) + n_known).cast("int"))
    columns = [natural_key, surrogate_key, "n_lines"]
    return numbered.select(surrogate_key, natural_key, *payload), staging.write(seen.select(*columns).unionByName(numbered.select(*columns)), f"keys_{natural_key}")


def further_star(clean: DataFrame, base: Warehouse, staging: Staging) -> dict[str, DataFrame]:
    """P3-P9 for the new lines: the rows that each table gains, and the hot keys among them."""

    def members(dim: str, known: DataFrame, *columns: str | list[str]) -> tuple[DataFrame, DataFrame]:
        return further_members(clean, known, base.rows(dim), *columns, staging)

    (customer, customers), (product, products), (region, regions) = side_by_side(
        clean.sparkSession,
        partial(members, "dim_customer", base["dim_customer"], "customer_id", ["customer_name"], "customer_key"),
        partial(members, "dim_product", base["dim_product"], "product_name", ["category"], "product_key"),
        partial(members, "dim_region", base["dim_region"].withColumnRenamed("region_name", "region"), "region", [], "region_key"),
    )
    return {
        "dim_customer": customer,
        "dim_product": product,
        "dim_region": region.withColumnRenamed("region", "region_name"),
        "dim_date": dates(clean).join(base["dim_date"].select("date_key"), "date_key", "left_anti"),
        "fact_sales": fact(clean, customers, products, regions.withColumnRenamed("region", "region_name"), staging),
        HOT_LINES: hot_keys({"customer_key": customers, "product_key": products, "region_key": regions}),
    }


def further_months(star: Warehouse, added: DataFrame, before: DataFrame) -> DataFrame:
    """Q8 after ``added``, the new rows of the fact: months without new lines are taken from ``before``, the others are made
    again from their own lines, of which the scan reads the years only. Months and years are bounded by the calendar."""
    month = F.expr("date_key div 100")
    touched = added.select(month.alias("touched")).distinct()
    years = [r[0] for r in added.select(SALE_YEAR).distinct().collect()]
    lines = star["fact_sales"].where(F.col(SALE_YEAR).isin(years)).join(F.broadcast(touched), month == F.col("touched"), "left_semi")
    again = monthly_kpis(Warehouse(star.tables | {"fact_sales": lines}))
    return again.unionByName(before.join(F.broadcast(touched), F.col("year") * 100 + F.col("month") == F.col("touched"), "left_anti"))


def append(raw: DataFrame, root: str, staging: Staging) -> Appended:
    """Add a feed to the published run, as a run that holds the new rows and names the ones before.

    It is published only if its rows pass the constraints, against dimensions as they are with it, and if no other load
    was published meanwhile; else the new lines are cleaned again for what is there then. ``sale_key`` continues where the
    run before ends, so it is checked among the new lines only.
    """
    spark = raw.sparkSession
    typed = staging.write(typed_lines(raw), "typed")
    attempt = 0
    while True:
        number, base = last_published(spark, root)
        if base is None:
            raise ValueError(f"nothing is published under {root}; load a feed first")
        attempt += 1
        done = _append_to(typed, root, number, base, Staging(spark, f"{staging.folder}/attempt-{attempt}"))
        if done:
            staging.drop("typed")
            return done


def _append_to(typed: DataFrame, root: str, number: int, base: str, staging: Staging) -> Appended | None:
    spark, old = typed.sparkSession, read_run(typed.sparkSession, root, base)
    cleaned = clean_further(typed, spark, root, base, old.rows("fact_sales"), staging)
    n_overtaken = overtaken(stored_parts(spark, root, base, PROFILE), stored_parts(spark, root, base, MEDIANS), cleaned.medians)
    part = write_run(further_star(cleaned.lines, old, staging) | stored_state(cleaned), root)
    staging.drop(KEYED_LINES)
    run = added_to(base, part)
    try:
        star, added = read_run(spark, root, run, extras=False), read_run(spark, root, part, extras=False)["fact_sales"]
        require_passed(constraint_checks(Warehouse(star.tables | {"fact_sales": added})))
        add_to_run(further_months(star, added, old.monthly), root, part, MONTHLY)
        published = publish(spark, root, run, after=number)
    except BaseException:
        discard_run(spark, root, part)
        raise
    if published is None:
        discard_run(spark, root, part)
        return None
    return Appended(cleaned, read_run(spark, root, run), added.count(), n_overtaken)
