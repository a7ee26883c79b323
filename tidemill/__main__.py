"""Command line: ``spark-submit`` or ``python -m tidemill features|windows``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemill.plans import run_window_job, write_feature_table
from tidemill.plans.windows import PROCESSING_TIME, WATERMARK
from tidemill.sources import clear_scratch, read_transactions


def _session(name: str) -> SparkSession:
    """The master and sizes are left to ``spark-submit``."""
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        # Lets adaptive execution join by hashing instead of sorting where every partition has been measured
        # to be smaller than this.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .getOrCreate()
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemill")
    jobs = parser.add_subparsers(dest="job", required=True)

    features = jobs.add_parser("features", help="transactions (Parquet) to feature table (Parquet)")
    features.add_argument("--input", required=True)
    features.add_argument("--output", required=True)
    features.add_argument("--partitions", type=int, help="redistribute the input first; seldom worth it")

    windows = jobs.add_parser("windows", help="event feed (JSON lines) to window aggregates")
    windows.add_argument("--input", required=True)
    windows.add_argument("--output", required=True)
    windows.add_argument("--window", type=int, default=10, help="tumbling window in seconds")
    windows.add_argument("--watermark", type=float, default=5.0, help="tolerance for late events in seconds")
    windows.add_argument("--late", choices=(WATERMARK, PROCESSING_TIME), default=WATERMARK)
    windows.add_argument("--flush", action="store_true", help="the feed is finished: write the open windows too")
    windows.add_argument("--max-files", type=int, help="files per micro-batch")

    args = parser.parse_args(argv)
    spark = _session(f"tidemill-{args.job}")
    if args.job == "features":
        rows = write_feature_table(read_transactions(spark, args.input, args.partitions), args.output)
        print(f"{rows} rows written to {args.output}")
    else:
        report = run_window_job(
            spark, args.input, args.output, args.window, args.watermark, args.late,
            max_files=args.max_files, flush=args.flush,
        )
        for line in report.toJSON().take(1):
            print(line)
    clear_scratch(spark)


if __name__ == "__main__":
    main()
