"""The whole feature table as one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemill.operators import (
    attach_by_key,
    entity_summary,
    with_indicators,
    with_interactions,
    with_log_features,
    with_time_features,
    with_zscores,
)
from tidemill.operators.aggregates import ROWS
from tidemill.sources import CATEGORIES, DEVICES, write_table

LOGGED = ("amount", "session_duration", "page_views")
NORMALISED = ("amount", "session_duration", "page_views", "items_in_cart")


def with_flags(
    df: DataFrame, categories: Sequence[str] = CATEGORIES, devices: Sequence[str] = DEVICES
) -> DataFrame:
    return with_indicators(
        df, {"category": categories, "device_type": devices}, {"category": "cat_", "device_type": "dev_"}
    )


def feature_table(
    transactions: DataFrame, categories: Sequence[str] = CATEGORIES, devices: Sequence[str] = DEVICES
) -> DataFrame:
    """Transactions with time, log, flag, interaction, user and z-score features, one row per input row.

    The user features come first because their join may shuffle the rows: it then moves the input columns
    only. The summaries are taken from the input itself, so each reads only its own columns.
    """
    summary = entity_summary(transactions)
    users = [c for c in summary.columns if c not in ("user_id", ROWS)]
    rows = (
        attach_by_key(transactions, summary, ["user_id"], ROWS)
        .transform(with_time_features)
        .transform(with_log_features, LOGGED)
        .transform(with_flags, categories, devices)
        .transform(with_interactions)
    )
    rows = rows.select("user_id", *[c for c in rows.columns if c not in ("user_id", *users)], *users)
    return with_zscores(rows, NORMALISED, basis=transactions)


def bucketed_features(transactions: DataFrame) -> DataFrame:
    """Each row of a table that is bucketed by ``user_id`` with the features of its user.

    Both the aggregate and the join find the rows of a user in one bucket, so nothing is shuffled. A user is then whole
    within one task: use it where none has much more than a bucket's share of the rows, else ``with_entity_summary``.
    """
    summary = entity_summary(transactions).drop(ROWS)
    return transactions.join(summary.hint("merge"), "user_id", "left")


def write_feature_table(transactions: DataFrame, path: str, **values: Sequence[str]) -> int:
    """Write the feature table and return its row count, which is taken while it is written."""
    written = Observation("features")
    write_table(feature_table(transactions, **values).observe(written, F.count(F.lit(1)).alias("rows")), path)
    return written.get["rows"]
