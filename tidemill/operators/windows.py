"""Aggregates over time windows.

Tumbling and sliding windows start at multiples of the slide since the epoch, so results do not depend on the
order in which events arrive. They work on tables and, behind a watermark, on streams.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import micros, ratio, rounded_mean
from tidemill.operators.aggregates import ROWS
from tidemill.operators.joins import attach_by_key

SECOND = 1_000_000
EXACT = "decimal(28, 6)"


def _duration(seconds: int) -> str:
    return f"{seconds} seconds"


def tumbling_totals(
    df: DataFrame, ts: str = "timestamp", key: str = "category", amount: str = "amount", size_s: int = 10
) -> DataFrame:
    """Event count and total amount per window and key."""
    return (
        df.groupBy(F.window(ts, _duration(size_s)).alias("_w"), key)
        .agg(F.count(F.lit(1)).alias("tx_count"), F.sum(amount).alias("total_amount"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), key, "tx_count", "total_amount")
    )


def sliding_average(
    df: DataFrame,
    ts: str = "timestamp",
    key: str = "region",
    amount: str = "amount",
    size_s: int = 30,
    slide_s: int = 10,
    digits: int = 2,
) -> DataFrame:
    """Mean amount per window and key; an event counts in each of the ``size_s / slide_s`` windows over it.

    Amounts count to six decimal places and are added up exactly, so the mean is rounded once and does not depend on
    the order of the rows. Amounts that no decimal can hold (NaN, infinite, 10^22 and more) count as missing: they are
    in neither the sum nor the count. Events are first
    added up per slide, and only those sums are copied into the windows. On a stream these are two aggregates in a row: the
    second takes the panes that the watermark has closed in the first, each at its ``window_time``. If the slide does not
    divide the size, Spark copies the events themselves.
    """
    exact = F.col(amount).try_cast(EXACT)
    if size_s % slide_s:
        windowed = df.groupBy(F.window(ts, _duration(size_s), _duration(slide_s)).alias("_w"), key).agg(
            F.try_sum(exact).alias("_sum"), F.count(exact).alias("_count")
        )
        start, end = F.col("_w.start"), F.col("_w.end")
    else:
        panes = df.groupBy(F.window(ts, _duration(slide_s)).alias("_pane"), key).agg(
            F.try_sum(exact).alias("_sum"), F.count(exact).alias("_count")
        )
        if df.isStreaming:
            windows = F.window(F.window_time("_pane"), _duration(size_s), _duration(slide_s)).alias("_w")
            windowed = panes.groupBy(windows, key).agg(F.try_sum("_sum").alias("_sum"), F.sum("_count").alias("_count"))
            return _means(windowed, F.col("_w.start"), F.col("_w.end"), key, digits)
        back = F.explode(F.sequence(F.lit(0), F.lit(size_s // slide_s - 1))).alias("_back")
        windowed = (
            panes.select("*", back)
            .select(
                (F.col("_pane.start") - F.make_dt_interval(secs=F.col("_back") * slide_s)).alias("_start"),
                key,
                "_sum",
                "_count",
            )
            .groupBy("_start", key)
            .agg(F.try_sum("_sum").alias("_sum"), F.sum("_count").alias("_count"))
        )
        start = F.col("_start")
        end = start + F.make_dt_interval(secs=F.lit(size_s))
    return _means(windowed, start, end, key, digits)


def _means(windowed: DataFrame, start: Column, end: Column, key: str, digits: int) -> DataFrame:
    mean = rounded_mean(F.col("_sum"), F.col("_count"), digits)
    return windowed.select(start.alias("window_start"), end.alias("window_end"), key, mean.alias("avg_amount"))


def trailing_average(
    df: DataFrame,
    ts: str = "timestamp",
    key: str = "user_id",
    amount: str = "amount",
    size_s: int = 30,
    pane_s: int | None = None,
    name: str = "trailing_avg",
) -> DataFrame:
    """Each row with the mean amount of its key over the ``size_s`` seconds up to and including its time.

    NULL for rows without a key or time. Amounts are added up per key and time, then per key and pane of
    ``pane_s`` seconds (``size_s`` if not given). Each pane is worked on apart from the others, so a key with
    many rows is spread over as many tasks as it has panes. The sum for time ``t`` is put together from

    * the panes that lie wholly inside the window,
    * the rows of the pane of ``t`` up to ``t``: a running sum in time order,
    * the rows of the pane of ``t - size_s`` from there on: these are copied one window ahead in time, which
      brings them into the pane of ``t``, and added by a running sum in reverse order.

    Running sums take time in proportion to the rows, whereas a sliding frame adds up each frame afresh.
    """
    span, pane = size_s * SECOND, (pane_s or size_s) * SECOND
    if span % pane:
        raise ValueError("pane_s must divide size_s")
    timed = df.withColumn("_t", micros(F.col(ts)))
    points = (
        timed.where(F.col(key).isNotNull() & F.col("_t").isNotNull())
        .groupBy(key, "_t")
        .agg(F.sum(amount).alias("_sum"), F.count(amount).alias("_count"), F.count(F.lit(1)).alias(ROWS))
        .withColumn("_pane", F.col("_t") - F.pmod(F.col("_t"), F.lit(pane)))
    )
    sum_type = points.schema["_sum"].dataType

    def entry(start: Column, t: Column, forward: bool, rows: Column) -> Column:
        values = [F.col("_sum"), F.col("_count")]
        zeros = [F.lit(0).cast(sum_type), F.lit(0).cast("long")]
        named = zip(
            values + zeros if forward else zeros + values, ("_fsum", "_fcount", "_bsum", "_bcount"), strict=True
        )
        return F.struct(start.alias("_pane"), t.alias("_t"), *[c.alias(n) for c, n in named], rows.alias(ROWS))

    no_rows = F.lit(0).cast("long")
    own = entry(F.col("_pane"), F.col("_t"), True, F.col(ROWS))
    ahead = entry(F.col("_pane") + span, F.col("_t") + span, False, no_rows)
    entries = points.select(key, F.explode(F.array(own, ahead)).alias("_e")).select(key, "_e.*")
    if span > pane:
        later = F.col("_pane") + F.col("_k") * pane
        between = (
            # Always true. It keeps the column, so that both uses of the points read the same shuffle.
            points.where(F.col(ROWS) > 0)
            .groupBy(key, "_pane")
            .agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"))
            .withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(span // pane - 1))))
            .select(key, entry(later, later, True, no_rows).alias("_e"))
            .select(key, "_e.*")
        )
        entries = entries.unionByName(between)

    frame = Window.partitionBy(key, "_pane")
    forward = frame.orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reverse = frame.orderBy(F.desc("_t")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = F.coalesce(F.sum("_fsum").over(forward), F.lit(0)) + F.coalesce(F.sum("_bsum").over(reverse), F.lit(0))
    counts = F.sum("_fcount").over(forward) + F.sum("_bcount").over(reverse)
    means = (
        entries.select(key, "_t", ROWS, ratio(sums, counts).alias(name))
        .where(F.col(ROWS) > 0)
        .select(key, "_t", name, ROWS)
    )
    return attach_by_key(timed, means, [key, "_t"], ROWS).drop("_t")


def window_record(
    windowed: DataFrame,
    key: str,
    values: Sequence[str],
    name: str = "aggregates",
    by: Sequence[str] = ("window_start", "window_end"),
    no_key: str = "(none)",
    most_keys: int = 100_000,
) -> DataFrame:
    """One row per window with a map from key to its aggregates (a struct, or a plain value if only one).

    The input has one row per window and key. A window of more than ``most_keys`` keys gets several rows, of so many keys
    each in their order, so that no row grows without bound. A map cannot hold a NULL key: its aggregates stand under
    ``no_key``. A key of that name gets a prime behind it, as does one that already has primes there, so that names stay
    different whatever the keys are.
    """
    value = F.col(values[0]) if len(values) == 1 else F.struct(*values)
    text = F.col(key).cast("string")
    unlike = F.when(text.rlike(f"^{re.escape(no_key)}'*\\z"), F.concat(text, F.lit("'"))).otherwise(text)
    named = F.coalesce(unlike, F.lit(no_key))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_named"))
    parts = windowed.withColumn("_named", named).withColumn("_part", F.floor((place - 1) / most_keys))
    entries = F.array_sort(F.collect_list(F.struct(F.col("_named").alias("key"), value.alias("value"))))
    return parts.groupBy(*by, "_part").agg(F.map_from_entries(entries).alias(name)).drop("_part")


def window_pivot(
    windowed: DataFrame,
    key: str,
    listed: Sequence[str],
    values: Sequence[str],
    by: Sequence[str] = ("window_start", "window_end"),
) -> DataFrame:
    """One row per window with columns ``<key value>_<aggregate>``, NULL where the window lacks that key."""
    cells = {
        f"{k}_{v}": F.max(F.when(F.col(key) == k, F.col(v))) for k in listed for v in values
    }
    return windowed.groupBy(*by).agg(*[cell.alias(n) for n, cell in cells.items()])
