"""Run the daily job: ``python -m kabuto --raw PATH --seeds DIR --tables ROOT [options]``, or only its
checks over the tables as published: ``python -m kabuto check --raw ...``. Either exits with 1 if an
error-severity check fails.

Submit with ``spark-submit -m``-style launchers or ``python -m`` on a node with a session
configured by the cluster (``spark.checkpoint.dir`` must name a shared folder).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from kabuto.plans.daily import check_published, run_daily
from kabuto.sources.raw import raw_sources
from kabuto.sources.schemas import RunDates

# Fixed value: the run day defaults to today's date in UTC+9 (the valuation date is the day before).
RUN_DAY_UTC_OFFSET_HOURS = 9


def default_run_day() -> dt.date:
    return (dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=RUN_DAY_UTC_OFFSET_HOURS)).date()


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="kabuto", description="Build and publish the daily portfolio and price tables.")
    p.add_argument("command", nargs="?", choices=["run", "check"], default="run", help="run (default), or check what is published")
    p.add_argument("--raw", required=True, help="base path of the raw feeds (one folder per feed)")
    p.add_argument("--seeds", required=True, help="folder of the CSV dimensions (<name>.csv)")
    p.add_argument("--tables", required=True, help="root of the published tables")
    p.add_argument("--format", default="parquet", help="format of the raw feeds (parquet, csv, ...)")
    p.add_argument("--run-day", type=dt.date.fromisoformat, help="run day; valuation is the day before (default: today, UTC+9)")
    p.add_argument("--as-of", type=dt.date.fromisoformat, help="valuation date (overrides --run-day)")
    p.add_argument("--update-from", type=dt.date.fromisoformat, help="first date written (default as-of - 2)")
    p.add_argument("--history-from", type=dt.date.fromisoformat, help="first date read for look-backs (default as-of - 27)")
    p.add_argument("--select", help="comma-separated published tables to build (default: all)")
    p.add_argument("--no-checks", action="store_true", help="skip the data-quality checks")
    p.add_argument("--no-fail-on-check", dest="fail_on_check", action="store_false", help="exit with 0 even if an error-severity check fails")
    p.add_argument("--replace-positions", action="store_true", help="drop rows of positions that late trades have closed")
    p.add_argument("--check-all-partitions", action="store_true", help="check whole tables, not only the partitions written")
    return p.parse_args(argv)


def dates_from(args: argparse.Namespace) -> RunDates:
    if args.as_of:
        return RunDates(args.as_of, args.update_from, args.history_from)
    base = RunDates.for_run_day(args.run_day or default_run_day())
    return RunDates(base.as_of, args.update_from or base.update_from, args.history_from)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    select = [s for s in args.select.split(",") if s] if args.select else None
    spark = SparkSession.builder.appName("kabuto-daily").getOrCreate()
    dates = dates_from(args)
    raw = raw_sources(spark, args.raw, args.seeds, args.format)
    if args.command == "check":
        checks = check_published(spark, raw, dates, args.tables, select, args.check_all_partitions)
    else:
        checks = run_daily(
            spark, raw, dates, args.tables, run_checks=not args.no_checks, replace_positions=args.replace_positions,
            select=select, check_all_partitions=args.check_all_partitions,
        ).get("checks")
    if checks is None:
        return 0
    failed = checks.filter("failures > 0").collect()  # one row per check at most
    for r in failed:
        print(json.dumps(r.asDict(), default=str))
    return int(args.fail_on_check and any(r["severity"] == "error" for r in failed))


if __name__ == "__main__":
    sys.exit(main())
