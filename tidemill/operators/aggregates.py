"""Grouped and whole-table aggregates. All of them combine on the map side before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import ratio, seconds_between, standardised
from tidemill.operators.joins import attach_by_key

ROWS = "_rows"


def entity_summary(
    df: DataFrame,
    key: str = "user_id",
    row_id: str = "transaction_id",
    amount: str = "amount",
    items: str = "items_in_cart",
    returned: str = "is_returned",
    session: str = "session_duration",
    prefix: str = "user_",
) -> DataFrame:
    """Whole-history behaviour of each entity: count, spend, its mean and deviation, basket, returns, sessions.

    ``_rows`` counts all rows of the key, for :func:`attach_by_key`.
    """
    return df.groupBy(key).agg(
        F.count(row_id).alias(f"{prefix}tx_count"),
        F.sum(amount).alias(f"{prefix}total_spend"),
        F.avg(amount).alias(f"{prefix}avg_amount"),
        F.stddev_samp(amount).alias(f"{prefix}std_amount"),
        F.avg(items).alias(f"{prefix}avg_items"),
        F.avg(returned).alias(f"{prefix}return_rate"),
        F.avg(session).alias(f"{prefix}avg_session"),
        F.count(F.lit(1)).alias(ROWS),
    )


def with_entity_summary(df: DataFrame, key: str = "user_id", **columns: str) -> DataFrame:
    """Each row with the summary of its entity; NULL features where the key is NULL."""
    return attach_by_key(df, entity_summary(df, key, **columns), [key], ROWS)


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``<c>_mean`` and ``<c>_std`` of each column, from one pass."""
    return df.select(
        *[F.avg(c).cast("double").alias(f"{c}_mean") for c in columns],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in columns],
    )


def with_zscores(df: DataFrame, columns: Sequence[str], basis: DataFrame | None = None) -> DataFrame:
    """``<c>_zscore`` of each column against the whole table.

    The statistics enter as a scalar subquery, which Spark evaluates once and which fails rather than
    multiplies rows should it ever hold more than one. ``basis`` is the frame to take them from, by default
    ``df``; pass a frame with the same rows but a shorter plan if there is one.
    """
    stats = moments(df if basis is None else basis, columns)
    packed = stats.select(F.struct(*stats.columns)).scalar()
    return df.withColumns(
        {
            f"{c}_zscore": standardised(F.col(c), packed.getField(f"{c}_mean"), packed.getField(f"{c}_std"))
            for c in columns
        }
    )


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.select(F.count(F.lit(1)).alias(name))


def throughput(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Events per second between the first and the last event, 0 where no time passed."""
    seconds = seconds_between(F.min(ts), F.max(ts))
    rate = F.when(seconds > 0, ratio(F.count(F.lit(1)), seconds)).otherwise(0.0)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count"), rate.alias("events_per_second"))


def lateness_summary(df: DataFrame, late: str, keys: Sequence[str] = (), limit: float = 0.05) -> DataFrame:
    """Total events (late ones included), late events, their share and whether it is above ``limit``."""
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col(late)).alias("late_events"),
    )
    share = F.coalesce(ratio(F.col("late_events"), F.col("total_events")), F.lit(0.0))
    return counted.withColumn("late_rate", share).withColumn("late_alert", F.col("late_rate") > F.lit(limit))
