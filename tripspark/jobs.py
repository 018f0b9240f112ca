"""Batch jobs, run as a file so that spark-submit finds them.

    spark-submit tripspark/jobs.py facts --bronze s3a://bronze/trips --start-date 2025-06-01
    spark-submit tripspark/jobs.py dimensions --zones s3a://bronze/zones.csv \\
        --from-date 2022-01-01 --to-date 2025-12-31
    spark-submit tripspark/jobs.py gold --start-date 2025-06-01
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
from datetime import date, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripspark.plans import gold, silver  # noqa: E402
from tripspark.session import CLUSTER_CONF  # noqa: E402
from tripspark.sinks.tables import create_namespace, refresh_table  # noqa: E402
from tripspark.sources.tables import table_exists  # noqa: E402

log = logging.getLogger(__name__)


def parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripspark.jobs")
    parser.add_argument("--namespace", default="silver", help="[catalog.]namespace of the tables")
    parser.add_argument("--provider", default="parquet", help="table format, e.g. iceberg")
    jobs = parser.add_subparsers(dest="job", required=True)

    facts = jobs.add_parser("facts", help="load a range of days")
    facts.add_argument("--bronze", required=True, help="root of the bronze folders")
    facts.add_argument("--start-date", type=date.fromisoformat, help="default: yesterday")
    facts.add_argument("--end-date", type=date.fromisoformat, help="default: the start date")
    facts.add_argument("--data-year-offset", type=int, default=1)
    facts.add_argument(
        "--cluster", action="store_true", help="order days by place and time at once"
    )

    dims = jobs.add_parser("dimensions", help="rebuild the four dimensions")
    dims.add_argument("--zones", required=True, help="zone lookup CSV")
    dims.add_argument("--from-date", type=date.fromisoformat, required=True)
    dims.add_argument(
        "--to-date", type=date.fromisoformat, required=True, help="the last day, all of it"
    )

    rollups = jobs.add_parser("gold", help="bring the aggregate tables up to date")
    rollups.add_argument("--gold-namespace", default="gold")
    rollups.add_argument(
        "--start-date",
        type=date.fromisoformat,
        help="first bronze day to read; without dates the days that changed",
    )
    rollups.add_argument("--end-date", type=date.fromisoformat, help="last bronze day to read")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one job and return its exit code: 1 only if every planned day failed."""
    create_namespace(spark, args.namespace, required=False)
    if args.job == "facts":
        days = silver.load_days(args.start_date, args.end_date, args.data_year_offset)
        outcome = silver.load_facts(
            spark, args.bronze, f"{args.namespace}.fact_trip", days, args.provider, args.cluster
        )
        # Worked out once and kept as a table, one row per planned day.
        refresh_table(outcome, f"{args.namespace}.load_outcome", args.provider)
        outcome = spark.table(f"{args.namespace}.load_outcome")
        counts = outcome.agg(
            F.count_if("success").alias("ok"), F.count_if(~col("success")).alias("failed"),
            F.sum("rows").alias("rows"),
        ).first()
        log.warning("days loaded: %s, failed: %s, rows: %s", *counts)
        return 1 if silver.all_failed(outcome) else 0
    if args.job == "dimensions":
        # Up to the midnight after the last day, so that all its minutes are there.
        last = args.to_date + timedelta(days=1)
        silver.build_dimensions(
            spark, args.zones, args.namespace, args.from_date, last, args.provider
        )
        return 0
    star = silver.star_from_tables(spark, args.namespace)
    ledger = f"{args.namespace}.fact_trip_ledger"
    if args.start_date is None and args.end_date is None and table_exists(spark, ledger):
        changed = gold.refresh_changed(star, ledger, args.gold_namespace, args.provider)
        log.warning("days rebuilt: %s", len(changed))
        return 0
    gold.refresh_gold(star, args.gold_namespace, args.provider, args.start_date, args.end_date)
    return 0


def main() -> None:
    args = parse(sys.argv[1:])
    builder = SparkSession.builder.appName(f"tripspark-{args.job}")
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    code = run(spark, args)
    spark.stop()
    sys.exit(code)


if __name__ == "__main__":
    main()
