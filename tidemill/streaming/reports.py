"""What a streaming job did, from the log it keeps of its micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import ratio
from tidemill.operators import exact_percentiles
from tidemill.streaming.commits import committed, read_committed

_SCHEMA = "total_events long, late_events long, rejected_lines long, started timestamp, latency_ms double, batch long"
BATCHES = "batches"


def batch_log(spark: SparkSession, output: str, after: int = -1) -> DataFrame:
    """One row for each micro-batch that ``ingest`` wrote to ``output``, later than number ``after``. None is forgotten."""
    return read_committed(spark, output, BATCHES, _SCHEMA).where(F.col("batch") > after)


def last_batch(spark: SparkSession, output: str) -> int:
    """Number of the last micro-batch in the log; -1 before the first."""
    return max(committed(spark, output, BATCHES), default=-1)


def latency_report(log: DataFrame) -> DataFrame:
    """One row: events, batches, late events, elapsed seconds, events per second, p50/p95/p99/max latency in ms.

    Events are those that could be parsed. A batch log has one row for each micro-batch. All values are 0 for an empty one.
    """
    begun = F.unix_micros("started")
    ended = begun + (F.col("latency_ms") * 1000).cast("long")
    elapsed = F.coalesce((F.max(ended) - F.min(begun)) / F.lit(1_000_000.0), F.lit(0.0))
    # The field names of the published report.
    totals = log.select(
        F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events"),
        F.count(F.lit(1)).alias("total_batches"),
        F.coalesce(F.sum("late_events"), F.lit(0)).alias("late_events"),
        F.round(elapsed, 2).alias("elapsed_seconds"),
        F.round(F.coalesce(ratio(F.sum("total_events"), elapsed), F.lit(0.0)), 1).alias("throughput_eps"),
    )
    latency = exact_percentiles(log, "latency_ms", (50, 95, 99))
    packed = latency.select(F.struct(*[F.round(F.col(c), 2).alias(c) for c in ("p50", "p95", "p99", "max")]))
    return totals.withColumn("latency_ms", packed.scalar())
