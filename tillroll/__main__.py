"""Command line for spark-submit: load a feed, add one, check a warehouse, export the flat view, delete old runs."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tillroll.operators.staging import Staging
from tillroll.plans.analytics import sales_flat
from tillroll.plans.quality import warehouse_checks
from tillroll.plans.retail import append_feed, run_etl
from tillroll.session import input_bytes, tune
from tillroll.sources.feed import read_feed
from tillroll.sources.reports import write_flat_csv
from tillroll.sources.warehouse import published_run, read_warehouse, run_folders, vacuum


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tillroll", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="clean a raw CSV feed and publish a new star schema")
    add = commands.add_parser("append", help="clean a further raw CSV feed and add it to the published star schema")
    for command in (load, add):
        command.add_argument("feed")
        command.add_argument("warehouse")
        command.add_argument("--clean-csv", help="also write the cleaned lines as CSV")
        command.add_argument("--report", help="also write the quality report")
        command.add_argument("--single-line", action="store_true", help="the feed has no quoted line breaks; saves looking for one")
    check = commands.add_parser("validate", help="run the warehouse checks; exit code 1 when one fails")
    check.add_argument("warehouse")
    export = commands.add_parser("export", help="write the flat view as CSV")
    export.add_argument("warehouse")
    export.add_argument("target")
    clean = commands.add_parser("vacuum", help="delete all runs but the last published ones")
    clean.add_argument("warehouse")
    clean.add_argument("--keep", type=int, default=2)
    args = parser.parse_args(argv)

    spark = tune(SparkSession.builder.appName("tillroll").getOrCreate())
    if args.command in ("load", "append"):
        tune(spark, input_bytes(spark, args.feed))
        with Staging(spark) as staging:
            feed = read_feed(spark, args.feed, False if args.single_line else None, staging)
            if args.command == "load":
                run_etl(feed, args.warehouse, args.clean_csv, args.report)
            else:
                added = append_feed(feed, args.warehouse, args.clean_csv, args.report)
                print(f"{added.n_lines} lines added; a load of all feeds would cap {added.n_overtaken} older prices otherwise.")
        return 0
    if args.command == "vacuum":
        print(f"{len(vacuum(spark, args.warehouse, args.keep))} runs deleted.")
        return 0
    tune(spark, input_bytes(spark, run_folders(args.warehouse, published_run(spark, args.warehouse))))
    if args.command == "export":
        with Staging(spark) as staging:
            write_flat_csv(sales_flat(read_warehouse(spark, args.warehouse), staging), args.target)
    else:
        checks = warehouse_checks(read_warehouse(spark, args.warehouse)).orderBy("position").collect()
        for row in checks:
            print(f"[{row.status}] {row.check_name} (violations: {row.violations})")
        passed = sum(row.status == "PASS" for row in checks)
        print(f"\n{passed}/{len(checks)} checks passed.")
        return 0 if passed == len(checks) else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
