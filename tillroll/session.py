"""Session settings that the plans profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# The JVM does not compile methods beyond 8000 bytes of bytecode. Cleaning many text columns can come
# near that in one generated method; with this limit Spark splits such code instead.
# Shuffle files go when the query that wrote them ends, not when the driver happens to collect its garbage; results that
# are used again are written tables, so no query needs another's.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Input per task until there are MOST_TASKS of them; beyond that tasks grow, because the number of
# shuffle blocks grows with the square of the number of tasks.
TASK_BYTES = 256 << 20
MOST_TASKS = 30_000


# What the session had before it was sized for an input.
_KEPT = "tillroll.kept."
_SIZED = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes")


def input_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """Total size of the files under a path, at any depth; lists them without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def tune(spark: SparkSession, size: int = 0, packing: int = 1) -> SparkSession:
    """Apply the settings, and size scans and shuffles for ``size`` bytes of input.

    Shuffles start with enough partitions that none outgrows a task, and AQE merges small ones. Small
    inputs get the session's own numbers, also after a large one. ``packing`` tells how many times tighter the rows are
    packed where they are scanned: a task gets that much less, since what it unpacks must fit.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key in _SIZED:
        kept = spark.conf.get(_KEPT + key, None)
        if kept is not None:
            if kept:
                spark.conf.set(key, kept)
            else:
                spark.conf.unset(key)
            spark.conf.unset(_KEPT + key)
    tasks = min(-(-size // TASK_BYTES), MOST_TASKS)
    sized = {}
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        sized = {_SIZED[0]: tasks, _SIZED[1]: max(TASK_BYTES, size // tasks) // packing}
    elif tasks > 1 and packing > 1:
        sized = {_SIZED[1]: TASK_BYTES // packing}
    for key, value in sized.items():
        spark.conf.set(_KEPT + key, spark.conf.get(key, None) or "")
        spark.conf.set(key, str(value))
    return spark
