"""Operators that must see the events of a key in the order of their times, as streams.

Events wait in the state of their key until the watermark has passed them: from then on nothing earlier can come, as Spark
drops what is late. They are then taken in order, all of a key that are due at once. A timer at the earliest time for which a
key waits brings it back, also without new events, so a key is looked at only when it has something to do. State is bounded by
the events of one delay, and by what an operator keeps besides. Needs the RocksDB state store, which ``stateful`` sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidemill.functions import micros
from tidemill.streaming.feeds import DELAY_S, watermarked

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful(spark: SparkSession) -> None:
    """Choose the state store that these operators need, for queries started from now on."""
    if not spark.conf.get(_STORE, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(_STORE, _ROCKS)


class _InOrder(StatefulProcessor):
    """Events (time in microseconds, id, amount) of a key, handed to ``take`` in order once they are final."""

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t long, id long, amount double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [r for df in rows for r in zip(df["t"].tolist(), df["id"].tolist(), df["amount"].tolist(), strict=True)]
        yield from self._due(key, new, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._due(key, [], timerValues)

    def _due(self, key, new: list[tuple], timers) -> Iterator[pd.DataFrame]:
        passed = timers.getCurrentWatermarkInMs() * 1000
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        rows = sorted([*held, *new])
        due = [r for r in rows if r[0] <= passed]
        rest = rows[len(due) :]
        if rest and (due or new):
            self.waiting.put(rest)
        elif held and not rest:
            self.waiting.clear()
        found, wake = self.take(key, due, passed)
        times = [t for t in (wake, rest[0][0] if rest else None) if t is not None]
        if times:
            self.handle.registerTimer(-(-min(times) // 1000))
        if found is not None and len(found):
            yield found

    def take(self, key, due: list[tuple], passed: int) -> tuple[pd.DataFrame | None, int | None]:
        """What comes of the events, and the time at which the key wants to be looked at again, if any."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class _Anchored(_InOrder):
    def __init__(self, size: int):
        self.size = size

    def init(self, handle) -> None:
        super().init(handle)
        self.window = handle.getValueState("window", "start long, n long, amount double")

    def take(self, key, due, passed):
        known = tuple(self.window.get()) if self.window.exists() else None
        current, closed = known, []
        for t, _, amount in due:
            if current and t < current[0] + self.size:
                current = (current[0], current[1] + 1, current[2] + amount)
            else:
                closed += [current] if current else []
                current = (t, 1, amount)
        if current and current[0] + self.size <= passed:
            closed.append(current)
            current = None
        if current is None and known:
            self.window.clear()
        elif current != known:
            self.window.update(current)
        found = pd.DataFrame(closed, columns=["start", "tx_count", "total_amount"])
        found.insert(0, "key", key[0])
        return found, current[0] + self.size if current else None


class _Trailing(_InOrder):
    def __init__(self, size: int):
        self.size = size

    def init(self, handle) -> None:
        super().init(handle)
        self.recent = handle.getListState("recent", "t long, amount double")

    def take(self, key, due, passed):
        held = [tuple(r) for r in self.recent.get()] if self.recent.exists() else []
        all_ = [*held, *((t, amount) for t, _, amount in due)]  # held events are earlier
        kept = [r for r in all_ if r[0] > passed - self.size]
        if kept and (due or len(kept) < len(held)):
            self.recent.put(kept)
        elif held and not kept:
            self.recent.clear()
        found = None
        if due:
            t = np.array([r[0] for r in all_], np.int64)
            sums = np.concatenate([[0.0], np.cumsum([r[1] for r in all_])])
            own = t[len(held) :]
            first, last = np.searchsorted(t, own - self.size, "left"), np.searchsorted(t, own, "right")
            found = pd.DataFrame({"id": [r[1] for r in due], "t": own, "mean": (sums[last] - sums[first]) / (last - first)})
            found.insert(0, "key", key[0])
        return found, kept[-1][0] + self.size if kept else None


def _fed(events: DataFrame, ts: str, key: str, amount: str, event_id: str | None, delay_s: float) -> DataFrame:
    stateful(events.sparkSession)
    number = F.lit(0) if event_id is None else F.col(event_id)
    # Rows reach Python as named tuples, whose names cannot begin with an underscore.
    return watermarked(events, ts, delay_s).select(
        F.col(key).alias("key"), F.col(ts).alias("at"), micros(F.col(ts)).alias("t"), number.cast("long").alias("id"), F.col(amount).cast("double").alias("amount")
    )


def anchored_stream(
    events: DataFrame,
    size_s: int = 10,
    delay_s: float = DELAY_S,
    ts: str = "timestamp",
    key: str = "user_id",
    amount: str = "amount",
) -> DataFrame:
    """Event count and total amount per key and event-anchored window: the windows of ``anchored_tumbling``, each once the
    watermark has passed its end. A key's state is the open window (start, count, total) and the events that still wait.
    """
    kind = events.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("start", T.LongType()), T.StructField("tx_count", T.LongType()), T.StructField("total_amount", T.DoubleType())])
    fed = _fed(events, ts, key, amount, None, delay_s)
    found = fed.groupBy("key").transformWithStateInPandas(_Anchored(size_s * 1_000_000), schema, "append", "eventTime")
    return found.select(F.col("key").alias(key), F.timestamp_micros("start").alias("window_start"), "tx_count", "total_amount")


def trailing_stream(
    events: DataFrame,
    size_s: int = 30,
    delay_s: float = DELAY_S,
    ts: str = "timestamp",
    key: str = "user_id",
    amount: str = "amount",
    event_id: str = "event_id",
    name: str = "trailing_avg",
) -> DataFrame:
    """Each event (id, key, time) with the mean amount of its key over the ``size_s`` seconds up to and including its time: what
    ``trailing_average`` gives, once the watermark has passed the event. A key's state is the events of that span; it goes
    when the watermark has passed the last of them by as much, so keys that fall silent take no room.
    """
    kind = events.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("id", T.LongType()), T.StructField("t", T.LongType()), T.StructField("mean", T.DoubleType())])
    fed = _fed(events, ts, key, amount, event_id, delay_s)
    found = fed.groupBy("key").transformWithStateInPandas(_Trailing(size_s * 1_000_000), schema, "append", "eventTime")
    return found.select(F.col("id").alias(event_id), F.col("key").alias(key), F.timestamp_micros("t").alias(ts), F.col("mean").alias(name))
