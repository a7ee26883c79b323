"""Row-wise features: one projection per operator, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import cyclic, discounted, indicator, ratio
from tidemill.functions.temporal import PI


def with_time_features(df: DataFrame, ts: str = "timestamp", pi: float = PI) -> DataFrame:
    """Hour of day, day of week (1 = Sunday) and their positions on the daily and weekly cycle."""
    hour, weekday = F.hour(ts), F.dayofweek(ts)
    hour_sin, hour_cos = cyclic(hour, 24, pi)
    dow_sin, dow_cos = cyclic(weekday, 7, pi)
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": weekday,
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "dow_sin": dow_sin,
            "dow_cos": dow_cos,
        }
    )


def with_log_features(df: DataFrame, columns: Sequence[str], prefix: str = "log_") -> DataFrame:
    """``log(1 + x)`` of each column; NULL for x <= -1."""
    return df.withColumns({f"{prefix}{c}": F.log1p(F.col(c).cast("double")) for c in columns})


def with_indicators(df: DataFrame, values: Mapping[str, Sequence[str]], prefixes: Mapping[str, str]) -> DataFrame:
    """0/1 column ``<prefix><value>`` for each listed value of each column.

    The values are given rather than looked up, so the output schema does not depend on the data and no pass
    over it is needed.
    """
    return df.withColumns(
        {f"{prefixes[c]}{v}": indicator(F.col(c), v) for c, listed in values.items() for v in listed}
    )


def with_interactions(
    df: DataFrame,
    amount: str = "amount",
    items: str = "items_in_cart",
    views: str = "page_views",
    discount: str = "discount_pct",
) -> DataFrame:
    """Spend per item, spend per page view (counting one extra view) and amount net of discount."""
    return df.withColumns(
        {
            "spend_per_item": ratio(F.col(amount), F.col(items)),
            "spend_per_view": ratio(F.col(amount), F.col(views) + F.lit(1)),
            "net_amount": discounted(F.col(amount), F.col(discount)),
        }
    )
