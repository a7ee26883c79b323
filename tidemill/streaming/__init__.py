"""Structured Streaming over event feeds."""

from tidemill.streaming.commits import OPEN, commit, committed, compact, read_committed, vacuum, withdraw
from tidemill.streaming.feeds import (
    deduplicated_stream,
    drain,
    ingest,
    logged_schema,
    open_windows,
    sliding_stream,
    start,
    tumbling_stream,
    watermarked,
)
from tidemill.streaming.ordered import anchored_stream, stateful, trailing_stream
from tidemill.streaming.reports import batch_log, last_batch, latency_report

__all__ = [
    "OPEN",
    "commit",
    "committed",
    "compact",
    "read_committed",
    "vacuum",
    "withdraw",
    "anchored_stream",
    "batch_log",
    "deduplicated_stream",
    "drain",
    "ingest",
    "last_batch",
    "latency_report",
    "logged_schema",
    "open_windows",
    "sliding_stream",
    "start",
    "stateful",
    "trailing_stream",
    "tumbling_stream",
    "watermarked",
]
