"""Row-wise and aggregated features on small literal tables."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemill.functions import iso_text, parse_iso, rounded_mean, shed_and_round
from tidemill.operators import (
    flag_late,
    drop_late,
    lateness_summary,
    throughput,
    with_entity_summary,
    with_indicators,
    with_interactions,
    with_log_features,
    with_time_features,
    with_zscores,
)
from tidemill.plans import feature_table, write_feature_table
from tidemill.sources import TRANSACTION

NOON_SUNDAY = dt.datetime(2024, 1, 7, 12, 30)


def transaction(i, user=1, amount=10.0, **other):
    row = {
        "transaction_id": i, "user_id": user, "timestamp": NOON_SUNDAY, "amount": amount, "category": "food",
        "region": "north", "device_type": "mobile", "session_duration": 60, "items_in_cart": 2, "is_returned": 0,
        "discount_pct": 0.25, "page_views": 4,
    }
    return row | other


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in TRANSACTION.names) for r in rows], TRANSACTION)


def test_time(spark):
    row = frame(spark, [transaction(1)]).transform(with_time_features).first()
    assert (row.hour, row.day_of_week) == (12, 1)
    assert row.hour_sin == pytest.approx(math.sin(2 * 3.14159 * 12 / 24))
    assert row.dow_cos == pytest.approx(math.cos(2 * 3.14159 / 7))
    assert row.hour_sin**2 + row.hour_cos**2 == pytest.approx(1)


def test_logs_are_null_at_minus_one_and_below(spark):
    df = spark.createDataFrame([(-2.0,), (-1.0,), (0.0,), (math.e - 1,), (None,)], "x double")
    assert [r.log_x for r in with_log_features(df, ["x"]).collect()] == [None, None, 0.0, pytest.approx(1.0), None]


def test_indicators(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    rows = with_indicators(df, {"c": ["a", "b"]}, {"c": "is_"}).collect()
    assert [(r.is_a, r.is_b) for r in rows] == [(1, 0), (0, 0), (None, None)]


def test_interactions_with_empty_basket(spark):
    row = frame(spark, [transaction(1, items_in_cart=0)]).transform(with_interactions).first()
    assert (row.spend_per_item, row.spend_per_view, row.net_amount) == (None, 2.0, 7.5)


def test_user_features(spark):
    rows = [transaction(1, 7, 1.0), transaction(2, 7, 3.0, is_returned=1), transaction(3, 8, 5.0), transaction(4, None)]
    got = {r.transaction_id: r for r in with_entity_summary(frame(spark, rows)).collect()}
    assert len(got) == 4
    assert (got[1].user_tx_count, got[1].user_total_spend, got[1].user_avg_amount) == (2, 4.0, 2.0)
    assert got[1].user_std_amount == pytest.approx(math.sqrt(2))
    assert got[2].user_return_rate == 0.5
    assert got[3].user_std_amount is None
    assert got[4].user_tx_count is None and got[4].user_total_spend is None


def test_zscores(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(10)], "x double, same double")
    scored = with_zscores(df, ["x", "same"])
    mean, std, same = scored.select(F.avg("x_zscore"), F.stddev("x_zscore"), F.max("same_zscore")).first()
    assert mean == pytest.approx(0, abs=1e-12) and std == pytest.approx(1) and same == 0.0
    one = with_zscores(df.limit(1), ["x"]).first()
    assert one.x_zscore == 0.0
    assert with_zscores(df.limit(0), ["x"]).count() == 0


def test_whole_table(spark, tmp_path):
    df = frame(spark, [transaction(i, i % 3) for i in range(20)])
    table = feature_table(df)
    assert len(table.columns) == 44 and table.columns[0] == "user_id"
    assert write_feature_table(df, str(tmp_path / "out")) == 20
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.exceptAll(table).count() == 0 and back.count() == 20


def test_rounding(spark):
    values = [1.005, 2.675, -1.005, 0.125, 1.0049, 1.0049998, 3.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    shown = [r.y for r in df.select(shed_and_round(F.col("x"), 2).alias("y")).collect()]
    assert shown == [1.01, 2.68, -1.01, 0.13, 1.0, 1.0, 3.0, None]


def test_rounded_mean_is_exact(spark):
    cases = [("0.02", 8, 0.0), ("0.04", 8, 0.01), ("-0.04", 8, -0.01), ("100499.98", 100_000, 1.0), ("100500.00", 100_000, 1.01),
             (None, 0, None), ("0", 3, 0.0)]
    df = spark.createDataFrame([(s, n) for s, n, _ in cases], "s string, n long")
    got = [r[0] for r in df.select(rounded_mean(F.col("s").cast("decimal(38,6)"), F.col("n"), 2)).collect()]
    assert got == [want for _, _, want in cases]


def test_iso_text(spark):
    df = spark.createDataFrame([(NOON_SUNDAY,), (NOON_SUNDAY.replace(microsecond=120),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(iso_text(F.col("t"))).collect()] == [
        t.replace(tzinfo=dt.timezone.utc).isoformat() for t in (NOON_SUNDAY, NOON_SUNDAY.replace(microsecond=120))
    ]
    bad = spark.createDataFrame([("yesterday",)], "s string")
    assert bad.select(parse_iso(F.col("s"))).first()[0] is None


def test_lateness_is_strict(spark):
    at = [NOON_SUNDAY + dt.timedelta(seconds=s) for s in (0, 5, 6)]
    df = spark.createDataFrame([(NOON_SUNDAY, t) for t in at], "t timestamp_ntz, arrived timestamp_ntz")
    flagged = flag_late(df, "t", F.col("arrived"))
    assert [r.is_late for r in flagged.collect()] == [False, False, True]
    assert drop_late(df, "t", F.col("arrived")).count() == 2
    row = lateness_summary(flagged, "is_late").first()
    assert (row.total_events, row.late_events, row.late_alert) == (3, 1, True)
    empty = lateness_summary(flagged.limit(0), "is_late").first()
    assert (empty.total_events, empty.late_rate, empty.late_alert) == (0, 0.0, False)


def test_throughput(spark):
    times = [("a", 0), ("a", 2), ("b", 1)]
    df = spark.createDataFrame([(k, NOON_SUNDAY + dt.timedelta(seconds=s)) for k, s in times], "k string, t timestamp_ntz")
    got = {r.k: (r.event_count, r.events_per_second) for r in throughput(df, "t", ["k"]).collect()}
    assert got == {"a": (2, 1.0), "b": (1, 0.0)}
