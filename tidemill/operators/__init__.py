"""Operators from DataFrame to DataFrame."""

from tidemill.operators.aggregates import (
    entity_summary,
    lateness_summary,
    moments,
    row_count,
    throughput,
    with_entity_summary,
    with_zscores,
)
from tidemill.operators.anchored import anchored_tumbling
from tidemill.operators.features import with_indicators, with_interactions, with_log_features, with_time_features
from tidemill.operators.joins import attach_by_key, skip_processed
from tidemill.operators.percentiles import approx_percentiles, exact_percentiles, merged_percentiles, percentile_sketches
from tidemill.operators.quality import drop_late, drop_replays, flag_late, split_corrupt
from tidemill.operators.windows import (
    sliding_average,
    trailing_average,
    tumbling_totals,
    window_pivot,
    window_record,
)

__all__ = [
    "anchored_tumbling",
    "approx_percentiles",
    "attach_by_key",
    "drop_late",
    "drop_replays",
    "entity_summary",
    "exact_percentiles",
    "flag_late",
    "lateness_summary",
    "merged_percentiles",
    "moments",
    "percentile_sketches",
    "row_count",
    "skip_processed",
    "sliding_average",
    "split_corrupt",
    "throughput",
    "trailing_average",
    "tumbling_totals",
    "window_pivot",
    "window_record",
    "with_entity_summary",
    "with_indicators",
    "with_interactions",
    "with_log_features",
    "with_time_features",
    "with_zscores",
]
