"""The whole run: feed -> cleaned lines -> star schema -> constraints -> publication -> reports; and further feeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillroll.operators.staging import Staging
from tillroll.plans.analytics import monthly_kpis
from tillroll.plans.append import Appended, append, stored_state
from tillroll.plans.cleaning import Cleaned, clean_sales
from tillroll.plans.quality import constraint_checks, dq_metrics, load_counts, require_passed
from tillroll.plans.star import KEYED_LINES, build_star
from tillroll.sources.feed import write_clean_csv
from tillroll.sources.reports import write_report
from tillroll.sources.warehouse import MONTHLY, Warehouse, add_to_run, discard_run, publish, read_run, write_run


@dataclass
class Load:
    """``cleaned`` reads the staging folder of the load, as long as it is there."""

    cleaned: Cleaned
    warehouse: Warehouse
    plans: dict[str, str]


def load(raw: DataFrame, root: str, staging: Staging) -> Load:
    """Clean the feed, write a new run of the warehouse, and publish it once its constraints hold.

    A run that fails its constraints is deleted; the staging folder is the caller's to delete.
    """
    spark = raw.sparkSession
    cleaned, plans = clean_sales(raw, staging), {}
    run = write_run(build_star(cleaned.lines, staging) | stored_state(cleaned), root, plans)
    staging.drop(KEYED_LINES)
    try:
        star = read_run(spark, root, run, extras=False)
        require_passed(constraint_checks(star))
        add_to_run(monthly_kpis(star), root, run, MONTHLY)
        publish(spark, root, run)
    except BaseException:
        discard_run(spark, root, run)
        raise
    return Load(cleaned, read_run(spark, root, run), staging.plans | plans)


def load_warehouse(raw: DataFrame, root: str) -> Warehouse:
    """The load; nothing of its intermediate tables is left, whether it succeeds or fails."""
    with Staging(raw.sparkSession) as staging:
        return load(raw, root, staging).warehouse


def run_etl(raw: DataFrame, root: str, clean_csv: str | None = None, report: str | None = None) -> Warehouse:
    """The load plus the cleaned text file and the quality report, where a path is given."""
    with Staging(raw.sparkSession) as staging:
        done = load(raw, root, staging)
        _write_files(done, clean_csv, report)
        return done.warehouse


def append_feed(raw: DataFrame, root: str, clean_csv: str | None = None, report: str | None = None) -> Appended:
    """Add a further feed to the published run. The files tell of the new lines, the report's row counts of all."""
    with Staging(raw.sparkSession) as staging:
        done = append(raw, root, staging)
        _write_files(done, clean_csv, report)
        return done


def _write_files(done: Load | Appended, clean_csv: str | None, report: str | None) -> None:
    if clean_csv:
        write_clean_csv(done.cleaned.lines, clean_csv)
    if report:
        write_report(dq_metrics(done.cleaned), load_counts(done.warehouse), report)
