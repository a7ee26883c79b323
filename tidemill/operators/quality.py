"""Late, repeated and malformed events. Usable on tables and on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import micros

CORRUPT = "_corrupt_record"


def is_late(ts: str, arrival: Column, tolerance_s: float) -> Column:
    """Whether an event arrived more than ``tolerance_s`` after it happened; exactly that much is on time."""
    return micros(arrival) - micros(F.col(ts)) > F.lit(round(tolerance_s * 1_000_000))


def flag_late(df: DataFrame, ts: str, arrival: Column, tolerance_s: float = 5.0, name: str = "is_late") -> DataFrame:
    return df.withColumn(name, is_late(ts, arrival, tolerance_s))


def drop_late(df: DataFrame, ts: str, arrival: Column | None = None, tolerance_s: float = 5.0) -> DataFrame:
    """Events that are not late; one without a time cannot be late and stays.

    Without ``arrival`` lateness is measured against the processing time of the batch.
    """
    now = F.current_timestamp() if arrival is None else arrival
    return df.where(~F.coalesce(is_late(ts, now, tolerance_s), F.lit(False)))


def drop_replays(df: DataFrame, event_id: str = "event_id") -> DataFrame:
    """One row per event id; all rows without an id stay, as nothing says that they are copies.

    Copies are first dropped within each task, so a hot id moves once per task.
    """
    known = F.col(event_id).isNotNull()
    return df.where(known).dropDuplicates([event_id]).unionByName(df.where(~known))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the text of the lines that could not be parsed."""
    bad = F.col(CORRUPT).isNotNull()
    return df.where(~bad).drop(CORRUPT), df.where(bad).select(F.col(CORRUPT).alias("line"))
