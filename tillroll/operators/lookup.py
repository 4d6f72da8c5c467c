"""Many-to-one equi joins that neither broadcast unchecked data nor pile a hot key on one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
# A key is hot from a 2000th of all lines on, so there are never more than 2000 hot keys.
HOT_KEYS = 2000
# Measured bytes of a row of two numbers, such as the hash of a natural key and its surrogate key.
KEY_BYTES = 32


def keys_fit(n: int) -> bool:
    """Whether a table of as many hashes and surrogate keys is within the bound of a broadcast."""
    return n * KEY_BYTES <= BROADCAST_BYTES


def is_broadcast(table_bytes: int) -> bool:
    """Whether lines meet a table of this measured size where they are."""
    return table_bytes <= BROADCAST_BYTES


def measured_bytes(table: DataFrame) -> int:
    """Size of the values of a table: one aggregate, bytes of text and binary plus the width of fixed types."""
    fixed, texts = 16, []
    for field in table.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
            fixed += 16
        else:
            fixed += 16 if isinstance(field.dataType, T.DecimalType) else 8
    width = F.lit(fixed)
    for text in texts:
        width = width + text
    return table.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]


def lookup(
    lines: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "left",
    weight: str | None = None,
    hot: DataFrame | None = None,
    table_bytes: int | None = None,
    broadcast_bytes: int | None = None,
    hot_keys: int | None = None,
) -> DataFrame:
    """Join ``lines`` to ``table``, which has one row per ``key``; ``how`` is left or inner.

    The result has the columns of ``lines``, then those of ``table`` without key and weight. A table within
    ``broadcast_bytes``, measured, is broadcast. Beyond that the hot keys - those with at least 1/``hot_keys`` of
    the lines, hence at most ``hot_keys`` of them - are broadcast and all other lines are shuffled on the key.
    ``weight`` names a column of ``table`` with the number of lines per key; or ``hot`` is a table of the hot keys,
    stored when they were counted. Without either, lines are shuffled on the key and Spark splits what is skewed
    when it runs. Nothing is read here but the size of a table (``table_bytes``, if the caller has it), and the
    total of the weights.
    """
    broadcast_bytes = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    hot_keys = HOT_KEYS if hot_keys is None else hot_keys
    payload = [c for c in table.columns if c not in (key, weight)]
    if table_bytes is None:
        table_bytes = measured_bytes(table.select(key, *payload))
    ordered = [*lines.columns, *payload]
    if table_bytes <= broadcast_bytes:
        return lines.join(F.broadcast(table.select(key, *payload)), key, how).select(*ordered)
    if weight is not None:
        threshold = table.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0] / hot_keys
        hot_rows, cold_rows = table.where(F.col(weight) >= threshold), table.where(F.col(weight) < threshold)
    elif hot is not None:
        few = F.broadcast(hot.select(key))
        hot_rows, cold_rows = table.join(few, key, "left_semi"), table.join(few, key, "left_anti")
    else:
        return lines.join(table.select(key, *payload), key, how).select(*ordered)
    hot_rows = hot_rows.select(F.col(key).alias("_hot_key"), *[F.col(c).alias(f"_hot_{c}") for c in payload])
    marked = lines.join(F.broadcast(hot_rows), F.col(key) == F.col("_hot_key"), "left")

    # Hot lines and lines with a null key match nothing below; a hash of the whole line spreads them over all tasks.
    idle = F.col("_hot_key").isNotNull() | F.col(key).isNull()
    marked = marked.withColumn("_cold_key", F.when(~idle, F.col(key))).withColumn(
        "_slice", F.when(idle, F.xxhash64(*lines.columns).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long"))
    )
    cold = cold_rows.select(
        F.col(key).alias("_table_key"),
        # Always 0, but not a constant, which Spark would leave out of the shuffle's keys.
        F.xxhash64(key).bitwiseAND(F.lit(0)).cast("long").alias("_table_slice"),
        *[F.col(c).alias(f"_cold_{c}") for c in payload],
    )
    joined = marked.join(
        cold,
        (F.col("_cold_key") == F.col("_table_key")) & (F.col("_slice") == F.col("_table_slice")),
        "left",
    )
    if how == "inner":
        joined = joined.where(F.col("_hot_key").isNotNull() | F.col("_table_key").isNotNull())
    return joined.select(
        *lines.columns,
        *[F.coalesce(F.col(f"_hot_{c}"), F.col(f"_cold_{c}")).alias(c) for c in payload],
    )
