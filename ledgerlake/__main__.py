"""Run the layered job: ``spark-submit`` or ``python -m ledgerlake SOURCE BASE``."""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession

from .operators import METRIC_EXPECTATIONS, TRANSACTION_EXPECTATIONS
from .plans import run_medallion


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser("ledgerlake", description="Ingest, clean and summarise.")
    parser.add_argument("source", help="CSV file or folder, any file system Spark can read")
    parser.add_argument("base", help="folder that receives <layer>/run_id=<run id>")
    parser.add_argument("--run-id", help="repeat one to replace its output (default: start time)")
    parser.add_argument("--median", choices=("exact", "approx"), default="exact")
    parser.add_argument("--expect", action="store_true", help="fail unless the suite passes")
    parser.add_argument("--strict-header", action="store_true", help="fail on another header")
    parser.add_argument("--by-name", action="store_true", help="bind columns by each file's header")
    parser.add_argument("--once", action="store_true", help="leave out rows of earlier runs")
    parser.add_argument("--keep-states", action="store_true", help="keep metrics that can be added up")
    parser.add_argument(
        "--route", action="store_true", help="with --quarantine, set aside rows that fail the suite"
    )
    parser.add_argument("--quarantine", action="store_true", help="set bad rows aside, go on")
    parser.add_argument("--check-balance", metavar="TYPE", help="fail unless its balances add up")
    parser.add_argument("--check-metrics", action="store_true", help="fail on implausible metrics")
    parser.add_argument("--skip-unreadable", action="store_true", help="skip unreadable files")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName("ledgerlake").getOrCreate()
    run = run_medallion(
        spark,
        args.source,
        args.base,
        run_id=args.run_id,
        median=args.median,
        suite=TRANSACTION_EXPECTATIONS if args.expect else (),
        strict_header=args.strict_header,
        quarantine=args.quarantine,
        balance_type=args.check_balance,
        metric_gate=METRIC_EXPECTATIONS if args.check_metrics else (),
        skip_unreadable=args.skip_unreadable,
        route=TRANSACTION_EXPECTATIONS if args.route else (),
        keep_states=args.keep_states,
        once=args.once,
        by_name=args.by_name,
    )
    print(json.dumps(run.summary()))


if __name__ == "__main__":
    main()
