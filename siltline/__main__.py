"""Jobs for spark-submit.

    requests --end 2024-03-01 --target PATH [--ledger PATH]
    bronze SOURCE --payloads PATH --bronze PATH --ledger PATH --day 2024-03-01 --ingested-at 2024-03-01T06:00:00
    silver TABLE --bronze PATH --target PATH [--table NAME] [--using FORMAT] [--exclude-prefix P] [--newest-landing] [--whole-years]
    profile --bronze PATH --target PATH
    gold --silver PATH --gold PATH --run-ts 2024-03-01T00:00:00
    check --silver PATH --gold PATH
"""

from __future__ import annotations

import argparse
import sys
from datetime import date, datetime

from pyspark.sql import SparkSession

from siltline.plans import bronze, silver, warehouse
from siltline.session import tune
from siltline.sources import landing
from siltline.sources.schemas import SILVER_COLUMNS
from siltline.sources.tree_profile import profile_files


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="siltline", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    todo = jobs.add_parser("requests")
    todo.add_argument("--end", required=True, type=date.fromisoformat)
    todo.add_argument("--target", required=True)
    todo.add_argument("--ledger", help="landings that need no request")
    landed = jobs.add_parser("bronze")
    landed.add_argument("source", choices=list(bronze.PAYLOADS))
    for name in ("payloads", "bronze", "ledger"):
        landed.add_argument(f"--{name}", required=True)
    landed.add_argument("--day", required=True, type=date.fromisoformat)
    landed.add_argument("--ingested-at", required=True, type=datetime.fromisoformat)
    one = jobs.add_parser("silver")
    one.add_argument("name", choices=list(SILVER_COLUMNS))
    one.add_argument("--bronze", required=True)
    one.add_argument("--target", required=True)
    one.add_argument("--table")
    one.add_argument("--using", default="parquet")
    one.add_argument("--exclude-prefix", action="append", default=[], help="a block of the wide matrix that is no province")
    one.add_argument("--newest-landing", action="store_true", help="of repeated cells of the wide matrix the newest counts")
    one.add_argument("--whole-years", action="store_true", help="the newest landing of a year replaces all of it")
    files = jobs.add_parser("profile")
    files.add_argument("--bronze", required=True)
    files.add_argument("--target", required=True)
    for job in ("gold", "check"):
        sub = jobs.add_parser(job)
        sub.add_argument("--silver", required=True)
        sub.add_argument("--gold", required=True)
        if job == "gold":
            sub.add_argument("--run-ts", required=True, type=datetime.fromisoformat)
    return parser


def main(argv: list[str] | None = None) -> int:
    """0 when the job is done; for ``check``, 1 when a test failed."""
    args = arguments().parse_args(argv)
    spark = tune(SparkSession.builder.appName(f"siltline-{args.job}").getOrCreate())
    if args.job == "requests":
        known = landing.read_ledger(spark, args.ledger).selectExpr("key as landing_key") if args.ledger else None
        bronze.weather_requests(spark, args.end, known).write.mode("overwrite").json(args.target)
        return 0
    if args.job == "bronze":
        print(bronze.ingest(spark, args.source, args.payloads, args.bronze, args.ledger, args.day, args.ingested_at))
        return 0
    if args.job == "silver":
        silver.refresh(spark, args.name, args.bronze, args.target, args.table, args.using, args.exclude_prefix, args.newest_landing, args.whole_years)
        return 0
    if args.job == "profile":
        profile_files(spark, args.bronze).write.mode("overwrite").parquet(args.target)
        return 0
    if args.job == "gold":
        warehouse.build(spark, args.silver, args.gold, args.run_ts)
        return 0
    results = warehouse.check(spark, args.silver, args.gold).orderBy("table_name", "column", "test").collect()
    for r in results:
        print(r.status, r.table_name, r.column, r.test, r.failures)
    return int(any(r.status == "fail" for r in results))


if __name__ == "__main__":
    sys.exit(main())
