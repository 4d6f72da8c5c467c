"""Written intermediate tables: they fix row positions, cut lineage and outlive lost executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

_CHECKPOINT_DIR = "spark.checkpoint.dir"
# Of written tables: two thirds of the bytes that Spark's default makes.
COMPRESSION = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if not folder:
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that every executor can reach")
    return folder.rstrip("/")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Through the file system that the path names, so it works wherever Spark writes."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Staging:
    """A fresh folder for the intermediate tables of one run; as a context, it is deleted at the end, come what may.

    ``plans`` keeps the plan that each table was written by.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/staging-{uuid.uuid4().hex}"
        self.plans: dict[str, str] = {}

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.delete()

    def delete(self) -> None:
        delete_folder(self.spark, self.folder)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once, packed tightly, and return a scan of it, whose size Spark knows when it plans a join."""
        path = f"{self.folder}/{name}"
        self.plans[name] = plan_of(df)
        df.write.option("compression", COMPRESSION).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads again, for what is written next to have its room."""
        delete_folder(self.spark, f"{self.folder}/{name}")


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def side_by_side(spark: SparkSession, *jobs: Callable[[], T]) -> list[T]:
    """Submit independent Spark jobs at once, so that small ones do not wait for each other."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [r.result() for r in running]
