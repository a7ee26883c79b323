"""Reading and writing of transaction tables and event feeds."""

from tidemill.sources.jsonl import FEED_FILES, feed_lines, is_blank, read_feed, stream_feed
from tidemill.sources.named import NamedLines, stream_named
from tidemill.sources.scratch import clear_scratch, delete_path, make_folder, scratch_mark, scratch_path, staged
from tidemill.sources.transactions import (
    CATEGORIES,
    DEVICES,
    EVENT,
    REGIONS,
    TRANSACTION,
    read_dated,
    read_transactions,
    write_bucketed,
    write_dated,
    write_table,
)

__all__ = [
    "CATEGORIES",
    "DEVICES",
    "EVENT",
    "FEED_FILES",
    "NamedLines",
    "REGIONS",
    "TRANSACTION",
    "clear_scratch",
    "delete_path",
    "feed_lines",
    "is_blank",
    "make_folder",
    "read_dated",
    "read_feed",
    "read_transactions",
    "scratch_mark",
    "scratch_path",
    "staged",
    "stream_feed",
    "stream_named",
    "write_bucketed",
    "write_dated",
    "write_table",
]
