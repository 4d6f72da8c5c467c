"""First row per key in feed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.positions import POSITION, hash_filter, is_small, maybe_in, position_sets
from tillroll.operators.staging import Staging

# In place of a position, which is 0 at least: the keys are known.
_KNOWN = -1


def key_hashes(keys: list[str]) -> list[Column]:
    """``_h1`` and ``_h2``: 128 bits by which rows with equal keys meet."""
    return [F.xxhash64(*keys).alias("_h1"), F.xxhash64(*reversed(keys), F.lit(1)).alias("_h2")]


def first_positions(rows: DataFrame, keys: list[str], staging: Staging, name: str, known: DataFrame | None = None) -> DataFrame:
    """The sets of positions (``position_sets``) of the first row per key; rows carry POSITION, null keys equal each other.

    Only a 64-bit hash of the keys and the position are shuffled, combined within each task before. Where a hash was seen
    more than once, the keys themselves are compared, combined before the shuffle as well: a group of copies of any size
    sends one row per task, and rows that share a hash by chance are all kept. Where there are too many such hashes to be
    broadcast, a bitmap of their lowest bits is, so that other rows stay where they are.

    ``known`` has the ``key_hashes`` of keys that are left out; rows meet them by 128 bits, in the same shuffle.
    """
    hashes = ["_h1"] if known is None else ["_h1", "_h2"]
    hashed = rows.select(*key_hashes(keys)[: len(hashes)], *keys, POSITION)
    every = hashed.select(*hashes, POSITION)
    if known is not None:
        every = every.unionByName(known.select(*hashes, F.lit(_KNOWN).alias(POSITION)))
    firsts = every.groupBy(*hashes).agg(F.min(POSITION).alias(POSITION), F.count("*").alias("n")).where(F.col(POSITION) > _KNOWN)
    # Of a hash seen once just the position is looked at later, of others just the hash.
    once = F.col("n") == 1
    firsts = staging.write(firsts.select(*[F.when(~once, F.col(h)).alias(h) for h in hashes], F.when(once, F.col(POSITION)).alias(POSITION)), f"{name}-hashes")
    repeated = firsts.where(F.col("_h1").isNotNull()).select(*hashes)
    small = is_small(repeated)
    again = hashed if small else maybe_in(hashed, staging.write(hash_filter(repeated, "_h1"), f"{name}-filter"), "_h1")
    # Inner, though hashes are distinct here: Spark would put a semi join, and its shuffle of all rows, before the filter.
    exact = again.join(F.broadcast(repeated) if small else repeated, hashes).groupBy(*hashes, *keys).agg(F.min(POSITION).alias(POSITION))
    return position_sets(firsts.where(F.col(POSITION).isNotNull()).select(POSITION).union(exact.select(POSITION)), staging, name)


def first_values(df: DataFrame, key: str, payload: list[str], order: str, staging: Staging) -> DataFrame:
    """Per key the payload of its first row, that row's position, and how many rows the key has.

    ``order`` must be unique. Position and count are hash aggregates, combined before the shuffle, so a key with a
    third of all rows costs no more; the payload then comes from the one row at each position. The keys are
    written in between and broadcast within the bound. Beyond it a bitmap of the positions is, of bounded size, so that
    no more rows are shuffled than there are keys, and a few beyond 2^FILTER_BITS positions.
    """
    firsts = df.groupBy(key).agg(F.min(order).alias("first_line"), F.count("*").alias("n_lines"))
    if not payload:
        return firsts
    firsts = staging.write(firsts, f"firsts_{key}")
    rows = df.select(F.col(order).alias("first_line"), *payload)
    if is_small(firsts):
        return rows.join(F.broadcast(firsts), "first_line").select(key, *payload, "first_line", "n_lines")
    rows = maybe_in(rows, staging.write(hash_filter(firsts, "first_line"), f"firsts_{key}-filter"), "first_line")
    return firsts.join(rows, "first_line").select(key, *payload, "first_line", "n_lines")
