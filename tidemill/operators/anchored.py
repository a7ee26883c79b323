"""Tumbling windows that open at an event rather than at a multiple of their size.

The first event of a key opens a window, the first event at or after its end opens the next, and so on. Each
start depends on the one before, so a key's timeline is cut into segments of so many rows and worked on in steps:

1. all rows are put in the order of key and time, by ranges of equal size, and cut every ``rows_per_segment`` rows, so a
   segment is as large for a key with a third of all rows as for any other;
2. for each segment, on its own: which exit follows from each start it could be entered with, a map from time to time;
3. the maps of the segments that lie in one range are composed to one map for the key and range;
4. along the ranges of a key: which start each range really is entered with;
5. from there, in each range: which start each segment is entered with;
6. for each segment, on its own: the window of each event.

Maps are short: a segment can only be entered within one window size of its first event. Step 4 sees one map for each
range, of which there are as many as shuffle partitions; the events of a key are never brought together in one task. The
steps are sequential folds, which no built-in function expresses, and run on Arrow batches that hold many groups.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import micros
from tidemill.sources.scratch import staged

Batches = Iterator[pa.RecordBatch]


def _whole_groups(batches: Batches) -> Iterator[pa.Table]:
    """Re-cut batches so that no group is spread over two of them; ``_seq`` is 1 at the start of a group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        starts = np.flatnonzero(_numbers(batch, "_seq") == 1)
        if len(starts):
            ready = [*held, batch.slice(0, starts[-1])]
            if sum(b.num_rows for b in ready):
                yield pa.Table.from_batches(ready)
            held = [batch.slice(starts[-1])]
        else:
            held.append(batch)
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


#: Microseconds that groups put one after the other may take up; far from where 64-bit numbers end.
_LINE = 2**61


def _lines(batches: Batches, size: int) -> Iterator[_Timelines]:
    """Whole groups, as many at a time as fit on one line."""
    for table in _whole_groups(batches):
        first = np.append(np.flatnonzero(_numbers(table, "_seq") == 1), table.num_rows)
        t = _numbers(table, "_t")
        origin = t[first[:-1]]
        room = np.maximum(t[first[1:] - 1].astype(float) - origin, size) + 2.0 * size
        part = (np.cumsum(room) // _LINE).astype(np.int64)
        for n in np.unique(part):
            own = np.flatnonzero(part == n)
            yield _Timelines(table.slice(first[own[0]], first[own[-1] + 1] - first[own[0]]), size)


def _numbers(data: pa.RecordBatch | pa.Table, column: str) -> np.ndarray:
    return data.column(column).to_numpy(zero_copy_only=False) if isinstance(data, pa.RecordBatch) else data[column].to_numpy()


class _Timelines:
    """Times of many groups on one line, with gaps between the groups that no window reaches across."""

    def __init__(self, table: pa.Table, size: int) -> None:
        self.table = table
        self.t = _numbers(table, "_t")
        self.first = np.flatnonzero(_numbers(table, "_seq") == 1)
        self.end = np.append(self.first[1:], len(self.t))
        self.group = np.repeat(np.arange(len(self.first)), self.end - self.first)
        self.origin = self.t[self.first]
        last = self.t[self.end - 1] if len(self.end) else self.t
        room = np.maximum(last - self.origin, size) + 2 * size  # what a group takes up on the line
        self.shift = np.cumsum(room) - room - self.origin
        self.line = self.t + self.shift[self.group]
        # The row that opens the next window, if a row opens one: its index, or the end of the group.
        self.next = np.minimum(np.searchsorted(self.line, self.line + size), self.end[self.group])

    def first_from(self, times: np.ndarray) -> np.ndarray:
        """For one time per group, the first row at or after it, or the end of the group."""
        return np.minimum(np.searchsorted(self.line, times + self.shift), self.end)


def _exits(size: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for lines in _lines(batches, size):
            table = lines.table
            rows = np.arange(len(lines.t))
            last = np.where(lines.next < lines.end[lines.group], lines.next, rows)
            while not np.array_equal(last[last], last):  # all chains at once, twice as far each round
                last = last[last]
            leave = lines.t[last] + size
            # A window that reaches in from an earlier segment ends at most one size after the segment begins.
            reach = np.minimum(lines.first_from(lines.origin + size), lines.end - 1)[lines.group]
            # Of neighbouring starts with the same exit only the latest is needed.
            kept = (rows == reach) | ((rows < reach) & (leave != np.append(leave[1:], 0)))
            offsets = np.append(0, np.cumsum(np.bincount(lines.group[kept], minlength=len(lines.first))))
            heads = table.select(["_key", "_range", "_segment"]).take(lines.first).append_column("_from", pa.array(lines.origin))
            for name, values in (("_enter", lines.t[kept]), ("_leave", leave[kept])):
                heads = heads.append_column(name, pa.ListArray.from_arrays(offsets.astype(np.int32), values))
            yield from heads.to_batches()

    return run


def _after(times: np.ndarray, enter: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """Where a segment leaves off that is entered at each of ``times``; it does not matter to one that is past it."""
    at = np.searchsorted(enter, times)
    return np.where(at < len(enter), leave[np.minimum(at, len(enter) - 1)], times)


def _composed(size: int) -> Callable[[Batches], Batches]:
    """The maps of the segments of a key and range, in their order, as one map."""

    def run(batches: Batches) -> Batches:
        for table in _whole_groups(batches):
            first = np.append(np.flatnonzero(_numbers(table, "_seq") == 1), table.num_rows)
            alone = np.diff(first) == 1  # most keys have one segment in a range, whose map stands as it is
            columns = ["_key", "_range", "_from", "_enter", "_leave"]
            yield from table.select(columns).take(first[:-1][alone]).to_batches()
            heads = table.select(columns[:3]).take(first[:-1][~alone])
            enters, leaves = [], []
            for a, b in zip(first[:-1][~alone], first[1:][~alone], strict=True):
                enter = leave = np.empty(0, np.int64)
                for i in range(a, b):
                    entry, exit_ = (np.array(table[c][i].as_py(), np.int64) for c in ("_enter", "_leave"))
                    if i == a:
                        enter, leave, reach = entry, exit_, table["_from"][i].as_py() + size
                        continue
                    leave = _after(leave, entry, exit_)
                    if enter[-1] < reach:  # a window that reaches in may end here only
                        more = entry > enter[-1]
                        more[np.searchsorted(entry, reach) + 1 :] = False
                        enter, leave = np.append(enter, entry[more]), np.append(leave, exit_[more])
                kept = leave != np.append(leave[1:], leave[-1] + 1)  # of starts with the same exit the latest
                enters.append(enter[kept])
                leaves.append(leave[kept])
            for name, values in (("_enter", enters), ("_leave", leaves)):
                heads = heads.append_column(name, pa.array(values, pa.list_(pa.int64())))
            yield from heads.to_batches()

    return run


def _openings(columns: list[str]) -> Callable[[Batches], Batches]:
    """Earliest time at which each segment may open a window, given what those before it left open.

    The first of a group is entered at its ``_first``.
    """

    def run(batches: Batches) -> Batches:
        free_from = 0
        for batch in batches:
            opens = np.empty(batch.num_rows, dtype=np.int64)
            rows = [batch.column(c).to_pylist() for c in ("_seq", "_first", "_enter", "_leave")]
            for i, (seq, first, enter, leave) in enumerate(zip(*rows, strict=True)):
                if seq == 1:
                    free_from = first
                opens[i] = free_from
                at = bisect_left(enter, free_from)
                if at < len(enter):
                    free_from = leave[at]
            found = pa.Table.from_batches([batch]).select(columns).append_column("_opens", pa.array(opens))
            yield from found.to_batches()

    return run


def _assigned(size: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for lines in _lines(batches, size):
            table = lines.table
            opens = _numbers(table, "_opens")[lines.first]
            marked = np.zeros(len(lines.t), dtype=bool)
            at, end = lines.first_from(np.maximum(opens, lines.origin)), lines.end
            while len(at):  # one window further in every group at once
                going = at < end
                at, end = at[going], end[going]
                marked[at] = True
                at = lines.next[at]
            start = lines.t.copy()
            # Rows before the first start of a segment belong to the window that reaches in.
            reached_into = lines.first[~marked[lines.first]]
            start[reached_into] = opens[lines.group[reached_into]] - size
            marked[lines.first] = True
            latest = np.maximum.accumulate(np.where(marked, np.arange(len(start)), 0))
            result = table.select(["_key", "_count", "_sum"]).append_column("_start", pa.array(start[latest]))
            yield from result.to_batches()

    return run


def _numbered(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows grouped, sorted and numbered from 1 within each group.

    The window function also obliges Spark to keep a group within one partition, in order, whatever join
    strategy or skew handling it chooses underneath.
    """
    return df.withColumn("_seq", F.row_number().over(Window.partitionBy(*by).orderBy(order)))


def anchored_tumbling(
    df: DataFrame,
    ts: str = "timestamp",
    key: str = "user_id",
    amount: str = "amount",
    size_s: int = 10,
    rows_per_segment: int = 1 << 14,
) -> DataFrame:
    """Event count and total amount per key and event-anchored window, in event-time order.

    Rows without a time belong to no window; rows without a key are a key of their own. ``rows_per_segment``, a power of
    two, sets how many different times of one key are handled together. The different times are written once, in order.
    """
    if rows_per_segment & (rows_per_segment - 1):
        raise ValueError("rows_per_segment must be a power of two")
    size = size_s * 1_000_000
    row = F.monotonically_increasing_id()  # number of the range, then of the row within it
    points = staged(
        df.select(F.col(key).alias("_key"), micros(F.col(ts)).alias("_t"), F.col(amount).alias("_amount"))
        .where(F.col("_t").isNotNull())
        .groupBy("_key", "_t")
        .agg(F.count(F.lit(1)).alias("_count"), F.sum("_amount").alias("_sum"))
        .repartitionByRange("_key", "_t")
        .sortWithinPartitions("_key", "_t")
        .select("*", F.shiftright(row, 33).alias("_range"), F.floor(row / F.lit(rows_per_segment)).cast("long").alias("_segment")),
        "points",
    )
    kind = T.StructField("_key", points.schema["_key"].dataType)
    numbers = lambda *names: [T.StructField(n, T.LongType()) for n in names]
    maps = [T.StructField(n, T.ArrayType(T.LongType())) for n in ("_enter", "_leave")]
    exits = staged(
        _numbered(points, ["_key", "_segment"], "_t").mapInArrow(
            _exits(size), T.StructType([kind, *numbers("_range", "_segment", "_from"), *maps])
        ),
        "exits",
    )
    composed = _numbered(exits, ["_key", "_range"], "_segment").mapInArrow(
        _composed(size), T.StructType([kind, *numbers("_range", "_from"), *maps])
    )
    entered = _numbered(composed, ["_key"], "_range").withColumn("_first", F.col("_from"))
    ranges = entered.mapInArrow(_openings(["_key", "_range"]), T.StructType([kind, *numbers("_range", "_opens")]))
    by_range = _numbered(_joined(exits, ranges.withColumnRenamed("_opens", "_first"), ["_key", "_range"]), ["_key", "_range"], "_segment")
    openings = by_range.mapInArrow(_openings(["_key", "_segment"]), T.StructType([kind, *numbers("_segment", "_opens")]))
    opened = _joined(points, openings, ["_key", "_segment"])
    assigned = _numbered(opened, ["_key", "_segment"], "_t").mapInArrow(
        _assigned(size),
        T.StructType([kind, *numbers("_count"), T.StructField("_sum", points.schema["_sum"].dataType), *numbers("_start")]),
    )
    totals = assigned.groupBy("_key", "_start").agg(F.sum("_count").alias("tx_count"), F.sum("_sum").alias("total_amount"))
    start = F.timestamp_micros("_start").cast(df.schema[ts].dataType)
    return totals.select(F.col("_key").alias(key), start.alias("window_start"), "tx_count", "total_amount")


def _joined(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Inner join of frames that have one more column on the right; NULL is a key like others."""
    renamed = right.withColumnsRenamed({c: f"_of{c}" for c in by})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in by])
    return left.join(renamed, same, "inner").drop(*[f"_of{c}" for c in by])
