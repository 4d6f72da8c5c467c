"""Shared inputs of the registered queries, derived once per session and data folder.

The feed stands for the raw files a load starts from: the text is written as CSV in feed order for what starts from files, as a
load does. What passes over the lines once takes them as they are derived, so they are neither written nor sorted for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.feed import feed_in_order, messy_feed
from tillroll.operators.staging import Staging
from tillroll.plans.cleaning import profile_typed, typed_lines
from tillroll.plans.retail import Load, append_feed, load, load_warehouse
from tillroll.session import input_bytes, tune
from tillroll.sources.feed import read_feed, write_csv
from tillroll.sources.schemas import ORDINAL, RAW_COLUMNS
from tillroll.sources.warehouse import Warehouse, read_warehouse

# Of feeds and exports as text; each of its files is of one task's size.
TEXT_COMPRESSION = "gzip"


@dataclass
class Workspace:
    spark: SparkSession
    staging: Staging
    raw: DataFrame
    sorted_feed: DataFrame | None = None
    _text: str | None = None
    _typed: DataFrame | None = None
    _profile: tuple[DataFrame, DataFrame] | None = None
    _load: Load | None = None
    _appended: Warehouse | None = None

    @property
    def in_order(self) -> DataFrame:
        """The feed in feed order."""
        return self.raw.orderBy(ORDINAL) if self.sorted_feed is None else self.sorted_feed

    @property
    def text(self) -> str:
        """The feed as CSV in feed order."""
        if self._text is None:
            path = f"{self.staging.folder}/feed_text"
            write_csv(self.in_order.select(*RAW_COLUMNS), path, TEXT_COMPRESSION)
            self._text = path
        return self._text

    @property
    def lines(self) -> DataFrame:
        """The typed lines, for a single pass."""
        return typed_lines(self.raw)

    @property
    def typed(self) -> DataFrame:
        if self._typed is None:
            self._typed = self.staging.write(self.lines, "typed")
        return self._typed

    @property
    def profile(self) -> DataFrame:
        return self._profiled()[0]

    @property
    def medians(self) -> DataFrame:
        return self._profiled()[1]

    @property
    def load(self) -> Load:
        if self._load is None:
            root = f"{self.staging.folder}/warehouse"
            self._load = load(read_feed(self.spark, self.text), root, Staging(self.spark))
            self._load.warehouse = read_warehouse(self.spark, root)
        return self._load

    @property
    def appended(self) -> Warehouse:
        """The first two thirds of the orders loaded, then the last two thirds added: the middle third comes twice."""
        if self._appended is None:
            root, order = f"{self.staging.folder}/appended", F.substring("order_id", 4, 20).cast("bigint")
            last = self.spark.read.csv(self.text, header=True).agg(F.max(order)).first()[0]
            raw = read_feed(self.spark, self.text)
            load_warehouse(raw.where(order * 3 <= 2 * last), root)
            self._appended = append_feed(raw.where(order * 3 > last), root).warehouse
        return self._appended

    def _profiled(self) -> tuple[DataFrame, DataFrame]:
        if self._profile is None:
            self._profile = profile_typed(self.typed, Staging(self.spark))
        return self._profile


_workspaces: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _workspaces:
        # The feed spells out as text what the tables hold as compressed numbers; typed lines are packed about as tightly again.
        tune(spark, 8 * input_bytes(spark, f"{sf_dir}/lineitem.parquet"), packing=8)
        _workspaces[key] = Workspace(spark, Staging(spark), messy_feed(spark, sf_dir), feed_in_order(spark, sf_dir))
    return _workspaces[key]
