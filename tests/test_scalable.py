"""Operators that divide large groups, against a plain loop, with data in which one group is very large."""

from __future__ import annotations

import bisect
import datetime as dt
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import (
    anchored,
    anchored_tumbling,
    approx_percentiles,
    attach_by_key,
    drop_replays,
    exact_percentiles,
    merged_percentiles,
    percentile_sketches,
    skip_processed,
    sliding_average,
    trailing_average,
    tumbling_totals,
    window_record,
    with_entity_summary,
)
from tidemill.plans.features import bucketed_features
from tidemill.sources import write_bucketed

EPOCH = dt.datetime(2024, 1, 1)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def skewed_events(n=3000, seed=1, span_s=4000, step=0.5):
    """Every third event belongs to user 1; some have no user; times repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 1 if i % 3 == 0 else rng.choice([None, *range(2, 40)])
        t = EPOCH + dt.timedelta(seconds=rng.randrange(int(span_s / step)) * step)
        rows.append((i, user, t, float(rng.randrange(1, 10_000)) / 100))
    return rows


def events_frame(spark, rows):
    return spark.createDataFrame(rows, "id long, user_id long, timestamp timestamp_ntz, amount double")


@pytest.mark.parametrize("max_hot", [1, 5, 65_536])
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_attach(spark, conf, max_hot, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    rows = skewed_events()
    df = events_frame(spark, rows)
    features = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"), F.max("id").alias("m"))
    got = attach_by_key(df, features, ["user_id"], "n", max_hot)
    assert got.columns == [*df.columns, "s", "m"]
    largest = {}
    for i, user, _, _ in rows:
        largest[user] = i
    assert {r.id: r.m for r in got.collect()} == {i: largest[u] if u else None for i, u, _, _ in rows}
    assert got.count() == len(rows)


def test_attach_spreads_hot_and_null_keys(spark, conf):
    """Rows with the hot key or none meet the shuffle in about equal parts."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(i, None if i % 4 == 1 else 1 if i % 4 == 2 else 10 + i, EPOCH, 1.0) for i in range(8000)]
    df = events_frame(spark, rows)
    features = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
    got = attach_by_key(df, features, ["user_id"], "n", 10)
    sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 8000 / 4 * 1.3


def test_attach_spreads_copies(spark, conf):
    """A third of the rows are copies of one row; the tasks that read them send them to different places."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    copy = F.col("id") % 3 == 0
    df = spark.range(0, 12_000, 1, 32).select(
        F.when(copy, 0).otherwise(F.col("id")).alias("id"), F.when(copy, -1).otherwise(F.col("id")).alias("k")
    )
    features = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"))
    got = attach_by_key(df, features, ["k"], "n", 10).withColumn("place", F.spark_partition_id())
    rows = got.collect()
    assert Counter((r.id, r.s) for r in rows) == Counter((0, 0) if i % 3 == 0 else (i, i) for i in range(12_000))
    copies = Counter(r.place for r in rows if r.k == -1)
    assert len(copies) == 4 and max(copies.values()) < 4000 / 2


def test_skip_processed(spark):
    df = spark.createDataFrame([(i, f"b{i % 5}" if i else None) for i in range(100)], "id long, batch string")
    done = spark.createDataFrame([("b1",), ("b1",), ("b3",), (None,)], "batch string")
    left = [r.id for r in skip_processed(df, done, "batch").collect()]
    assert sorted(left) == [i for i in range(100) if i == 0 or i % 5 not in (1, 3)]


def test_drop_replays(spark):
    df = spark.createDataFrame([(i % 7, i % 7) for i in range(100)], "event_id long, x long")
    assert sorted(r.event_id for r in drop_replays(df).collect()) == list(range(7))


def test_percentiles_of_few_values(spark):
    four = spark.createDataFrame([(v,) for v in (10.0, 1.0, 3.0, 2.0, None)], "v double")
    row = exact_percentiles(four, "v").first()
    assert (row.n, row.p50, row.p95, row.p99, row["max"]) == (4, 2.5, pytest.approx(8.95), pytest.approx(9.79), 10.0)
    one = exact_percentiles(four.where("v = 3"), "v").first()
    assert (one.p50, one.p99, one["max"]) == (3.0, 3.0, 3.0)
    none = exact_percentiles(four.limit(0), "v").collect()
    assert len(none) == 1 and tuple(none[0]) == (0, 0.0, 0.0, 0.0, 0.0)


def test_percentiles_of_group_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 4.0)], "k string, v double")
    got = {r.k: (r.n, r.p50) for r in exact_percentiles(df, "v", [50], ["k"]).collect()}
    assert got == {"a": (1, 1.0), "b": (0, 0.0), None: (1, 4.0)}


@pytest.mark.parametrize(("max_hot", "min_split", "steps"), [(1, 0, 4), (3, 0, 3), (4096, 0, 12), (4096, 500, 2), (4096, 10**6, 12)])
def test_percentiles_of_large_groups(spark, max_hot, min_split, steps):
    rng = random.Random(5)
    rows = [("big" if i % 3 else f"g{i % 8}", rng.choice([round(rng.lognormvariate(3, 2), 1), 7.0, -rng.random()])) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v double")
    groups = defaultdict(list)
    for k, v in rows:
        groups[k].append(v)
    percents = (0, 12.5, 50, 99, 100)
    for r in exact_percentiles(df, "v", percents, ["k"], max_hot, min_split, steps).collect():
        assert list(r)[2:-1] == pytest.approx(list(np.percentile(groups[r.k], percents)))
        assert (r.n, r["max"]) == (len(groups[r.k]), max(groups[r.k]))
    whole = exact_percentiles(df, "v", percents, min_split=min_split, steps=steps).first()
    assert list(whole)[1:-1] == pytest.approx(list(np.percentile([v for _, v in rows], percents)))


def test_approx_percentiles(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    assert tuple(approx_percentiles(df, "v").first()) == (500.0, 950.0, 990.0)


@pytest.mark.parametrize("pane_s", [None, 30, 10, 1])
def test_trailing_average(spark, pane_s):
    rows = skewed_events(1500, span_s=600)
    got = {r.id: r.trailing_avg for r in trailing_average(events_frame(spark, rows), size_s=30, pane_s=pane_s).collect()}
    assert len(got) == len(rows)
    by_user = defaultdict(list)
    for _, user, t, amount in rows:
        by_user[user].append((t, amount))
    for i, user, t, _ in rows:
        if user is None:
            assert got[i] is None
            continue
        inside = [a for at, a in by_user[user] if t - dt.timedelta(seconds=30) <= at <= t]
        assert got[i] == pytest.approx(sum(inside) / len(inside))


def test_trailing_average_needs_whole_panes(spark):
    with pytest.raises(ValueError, match="pane_s"):
        trailing_average(events_frame(spark, skewed_events(1)), size_s=30, pane_s=20)


def anchored_by_loop(rows, size_s):
    windows, current = {}, {}
    for _, user, t, amount in sorted(rows, key=lambda r: r[2]):
        if user not in current or t - current[user] >= dt.timedelta(seconds=size_s):
            current[user] = t
        count, total = windows.get((user, current[user]), (0, 0.0))
        windows[user, current[user]] = (count + 1, total + amount)
    return windows


def check_anchored(spark, rows, size_s, per_segment):
    got = anchored_tumbling(events_frame(spark, rows), size_s=size_s, rows_per_segment=1 << (per_segment - 1).bit_length()).collect()
    expected = anchored_by_loop(rows, size_s)
    assert {(r.user_id, r.window_start): r.tx_count for r in got} == {k: n for k, (n, _) in expected.items()}
    for r in got:
        assert r.total_amount == pytest.approx(expected[r.user_id, r.window_start][1])
    assert len(got) == len(expected)


@pytest.mark.parametrize("per_segment", [1, 2, 7, 10_000])
def test_anchored_windows(spark, per_segment):
    check_anchored(spark, skewed_events(), 10, per_segment)


def test_anchored_windows_of_a_hot_user_in_bounded_segments(spark, conf, monkeypatch):
    """A user with most of the rows lies in many ranges and segments, none of which has more rows than any other."""
    made = {}
    monkeypatch.setattr("tidemill.operators.anchored.staged", lambda df, name, real=anchored.staged: made.setdefault(name, real(df, name)))
    conf("spark.sql.shuffle.partitions", "6")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(i, 1 if i % 4 else i % 40, EPOCH + dt.timedelta(seconds=i * 7 % 5000), 1.0) for i in range(4000)]
    check_anchored(spark, rows, 60, 16)
    sizes = [r["count"] for r in made["points"].groupBy("_key", "_segment").count().collect()]
    ranges = [r["count"] for r in made["points"].groupBy("_range").count().collect()]
    assert max(sizes) <= 16 and len(ranges) == 6 and max(ranges) <= 2 * sorted(ranges)[3]
    assert made["exits"].where("_key = 1").select("_range").distinct().count() >= 4
    assert made["exits"].agg(F.max(F.size("_enter"))).first()[0] <= 16


def test_anchored_windows_over_small_batches(spark, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    check_anchored(spark, skewed_events(1200), 10, 3)


def test_anchored_windows_of_a_year(spark):
    """Many users in one batch, whose windows together span more than 64 bits of microseconds."""
    rows = [(i, i % 3000, EPOCH + dt.timedelta(days=37 * i % 4000), 1.0) for i in range(9000)]
    check_anchored(spark, rows, 365 * 86_400, 256)


def test_sliding_average_rounds_the_exact_mean(spark):
    df = spark.range(100_000).select(
        F.lit(EPOCH).alias("timestamp"), F.lit("x").alias("region"),
        F.when(F.col("id") < 49_998, 1.01).otherwise(1.0).cast("double").alias("amount"),
    )
    assert {r.avg_amount for r in sliding_average(df).collect()} == {1.0}  # the mean is 1.0049998


def test_anchored_windows_of_regular_events(spark):
    check_anchored(spark, [(i, 1, EPOCH + dt.timedelta(seconds=3 * i), 1.0) for i in range(400)], 10, 2)


@FEW
@given(
    seconds=st.lists(st.integers(-500, 500), min_size=1, max_size=60),
    size_s=st.integers(1, 40),
    per_segment=st.integers(1, 5),
)
def test_anchored_windows_of_any_events(spark, seconds, size_s, per_segment):
    check_anchored(spark, [(i, i % 2, EPOCH + dt.timedelta(seconds=s), 1.0) for i, s in enumerate(seconds)], size_s, per_segment)


def test_sliding_windows_hold_each_event_three_times(spark):
    df = events_frame(spark, skewed_events()).withColumn("region", F.lit("north"))
    summed = sliding_average(df, size_s=30, slide_s=10).collect()
    copied = Counter()
    for _, _, t, amount in skewed_events():
        start = int((t - EPOCH).total_seconds()) // 10 * 10
        for back in (0, 10, 20):
            copied[start - back] += 1
    assert {int((r.window_start - EPOCH).total_seconds()) for r in summed} == set(copied)
    assert sum(copied.values()) == 3 * df.count()
    # Without whole panes Spark copies the events; both ways must agree where both apply.
    by_events = df.groupBy(F.window("timestamp", "30 seconds", "10 seconds").alias("w")).agg(F.avg("amount").alias("a"))
    expected = {r.w.start: r.a for r in by_events.collect()}
    for r in summed:
        assert r.avg_amount == pytest.approx(expected[r.window_start], abs=0.0051)


def test_sliding_with_uneven_slide(spark):
    df = events_frame(spark, skewed_events(50)).withColumn("region", F.lit("north"))
    got = sliding_average(df, size_s=25, slide_s=10)
    assert got.select("window_start").distinct().count() == got.count() > 0


def test_window_record(spark):
    df = events_frame(spark, skewed_events(300)).withColumn("category", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    windows = tumbling_totals(df, size_s=1000)
    records = window_record(windows, "category", ("tx_count", "total_amount")).collect()
    assert sum(r.aggregates[k].tx_count for r in records for k in r.aggregates) == 300
    assert all(list(r.aggregates) == sorted(r.aggregates) for r in records)


def test_merged_sketches_keep_to_their_error(spark):
    rng = random.Random(2)
    rows = [(i % 30, "big" if i % 3 else "small", rng.lognormvariate(2, 3)) for i in range(30_000)] + [(0, "none", None), (1, "none", None)]
    df = spark.createDataFrame(rows, "day int, k string, v double")
    daily = percentile_sketches(df, "v", ["k", "day"])
    for r in merged_percentiles(daily, (1, 50, 99), ["k"]).collect():
        values = sorted(v for _, k, v in rows if k == r.k and v is not None)
        assert r.n == len(values)
        for p, found in zip((1, 50, 99), list(r)[2:], strict=True):
            assert found is None if not values else abs(bisect.bisect(values, found) / len(values) - p / 100) < 0.01


def test_bucketed_rows_are_not_shuffled(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [(i, i % 50, 1.0 * i, i % 4, i % 2, 60) for i in range(2000)]
    df = spark.createDataFrame(rows, "transaction_id long, user_id long, amount double, items_in_cart long, is_returned long, session_duration long")
    write_bucketed(df, "bucketed_rows", buckets=8, path=str(tmp_path / "b"))
    table = spark.table("bucketed_rows")
    found = bucketed_features(table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = with_entity_summary(df).select(*found.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    spark.sql("DROP TABLE bucketed_rows")
