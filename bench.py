"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``load`` is the whole run from the CSV files of the feed to the published star schema; the feed itself is derived
and written before, as ``feed``. Q1-Q8 then run on the published tables. Every result is consumed in full.
"""

from __future__ import annotations

import contextlib
import json
import os
import re
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.registry import QUERIES  # noqa: E402
from harness.workspace import workspace  # noqa: E402

HEADLINE = [
    "monthly_revenue", "category_profit", "top_product", "region_share", "customer_segments", "repeat_share",
    "sales_flat", "monthly_kpis", "dq_metrics", "warehouse_checks", "constraint_checks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillroll-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillroll-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    @contextlib.contextmanager
    def timed(name: str):
        start = time.perf_counter()
        yield
        seconds[name] = round(time.perf_counter() - start, 3)

    with timed("feed"):
        ws = workspace(spark, sf_dir)
    with timed("load"):
        ws.load  # noqa: B018
    for name in HEADLINE:
        with timed(name):
            QUERIES[name](ws).write.format("noop").mode("overwrite").save()
    lines = ws.raw.count()
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "load of the star schema and its queries",
        "value": round(sum(v for k, v in seconds.items() if k != "feed"), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else sf_dir,
        "feed_lines": lines,
        "load_lines_per_sec": round(lines / seconds["load"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
