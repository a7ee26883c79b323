"""Event feeds: parsing, windows behind a watermark, restart, late and repeated events."""

from __future__ import annotations

import datetime as dt
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.__main__ import main
from tidemill.operators import drop_late, drop_replays, sliding_average, split_corrupt, tumbling_totals, window_record
from tidemill.plans import WINDOWS, read_windows, run_window_job
from tidemill.plans import windows as window_job
from tidemill.sources import feed_lines, is_blank, read_feed, stream_feed, stream_named
from tidemill.streaming import (
    anchored_stream,
    batch_log,
    committed,
    compact,
    deduplicated_stream,
    drain,
    ingest,
    latency_report,
    open_windows,
    sliding_stream,
    trailing_stream,
    tumbling_stream,
    vacuum,
)
from tidemill.streaming import feeds

START = dt.datetime(2024, 3, 1, 10, 0, tzinfo=dt.timezone.utc)


class Feed:
    """A directory to which batch files are added, each complete when it appears and one second younger."""

    def __init__(self, root):
        self.path = root / "feed"
        self.path.mkdir()
        self.staged = root / "staged"
        self.count = 0
        self.next_id = 0

    def event(self, second, **other):
        event = {
            "event_id": self.next_id, "user_id": 1, "timestamp": (START + dt.timedelta(seconds=second)).isoformat(),
            "amount": 10.0 + second % 7, "category": "food" if second % 2 else "books", "region": "north",
            "device_type": "mobile", "session_duration": 60, "items_in_cart": 2, "is_returned": 0,
            "discount_pct": 0.1, "page_views": 3,
        }
        self.next_id += 1
        return event | other

    def add(self, *entries):
        self.staged.write_text("".join((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in entries))
        os.utime(self.staged, (1_700_000_000 + self.count,) * 2)
        self.staged.rename(self.path / f"batch_{self.count:06d}.jsonl")
        self.count += 1

    def seconds(self, first, last):
        self.add(*[self.event(s) for s in range(first, last)])


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path)


def events(spark, feed, **options):
    return split_corrupt(stream_feed(spark, str(feed.path), **options))[0]


def run(spark, stream, root, name="out"):
    drain(stream, str(root / name), str(root / f"{name}-progress"))
    return spark.read.schema(stream.schema).parquet(str(root / name))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_blank_and_corrupt_lines(spark, feed):
    feed.add(feed.event(0), "", "   ", '{"event_id": 7, "amount"', feed.event(1, amount="much"), feed.event(2))
    feed.add()
    (feed.path / "notes.txt").write_text("not an event\n")
    good, rejects = split_corrupt(read_feed(spark, str(feed.path)))
    assert sorted(r.event_id for r in good.collect()) == [0, 2]
    assert sorted(r.line[:13] for r in rejects.collect()) == ['{"event_id": ', '{"event_id": ']
    assert good.first().timestamp is not None


def test_lines_round_trip(spark, feed, tmp_path):
    feed.seconds(0, 20)
    good, _ = split_corrupt(read_feed(spark, str(feed.path)))
    feed_lines(good).write.text(str(tmp_path / "again"))
    again, _ = split_corrupt(read_feed(spark, str(tmp_path / "again"), files="part-*"))
    assert bag(again) == bag(good)


def test_stream_equals_table_for_closed_windows(spark, feed, tmp_path):
    for s in range(0, 100, 5):
        feed.seconds(s, s + 5)
    table, _ = split_corrupt(read_feed(spark, str(feed.path)))
    closed = F.col("window_end") <= F.lit(START + dt.timedelta(seconds=99 - 5)).cast("timestamp")
    stream = events(spark, feed, max_files=3)
    assert bag(run(spark, tumbling_stream(stream), tmp_path, "t")) == bag(tumbling_totals(table).where(closed))
    assert bag(run(spark, sliding_stream(stream), tmp_path, "s")) == bag(sliding_average(table).where(closed))


def test_restart_continues_open_windows(spark, feed, tmp_path):
    """Stopped in the middle of a window and started again, the job reports what an unbroken run does."""
    for s in range(0, 50, 5):
        feed.seconds(s, s + 5)
    stream = tumbling_stream(events(spark, feed))
    run(spark, stream, tmp_path, "resumed")
    for s in range(50, 100, 5):
        feed.seconds(s, s + 5)
    resumed = run(spark, stream, tmp_path, "resumed")
    unbroken = run(spark, stream, tmp_path, "unbroken")
    assert bag(resumed) == bag(unbroken)
    assert sum(r.tx_count for r in resumed.collect()) == 90
    assert bag(run(spark, stream, tmp_path, "resumed")) == bag(unbroken)


def test_watermark_drops_rows_of_closed_windows(spark, feed, tmp_path):
    feed.seconds(0, 30)
    stream = tumbling_stream(events(spark, feed))
    run(spark, stream, tmp_path)
    feed.add(feed.event(3), feed.event(28), feed.event(60))
    windows = run(spark, stream, tmp_path).groupBy("window_start").agg(F.sum("tx_count").alias("n"))
    assert sorted(r.n for r in windows.collect()) == [10, 10, 11]


def test_replays_are_dropped(spark, feed, tmp_path):
    feed.seconds(0, 10)
    first = [feed.event(s) for s in range(10, 14)]
    feed.add(*first)
    feed.add(*first, feed.event(14))
    unique = run(spark, deduplicated_stream(events(spark, feed, max_files=1)), tmp_path)
    assert sorted(r.event_id for r in unique.collect()) == list(range(15))


def test_processing_time_lateness(spark, feed, tmp_path):
    feed.seconds(0, 10)
    now = dt.datetime.now(dt.timezone.utc)
    feed.add(*[feed.event(0, timestamp=(now + dt.timedelta(seconds=s)).isoformat()) for s in (3600, 3601)])
    output = str(tmp_path / "out")
    ingest(stream_feed(spark, str(feed.path)), output, tolerance_s=60, drop_late=True).awaitTermination()
    log = spark.read.parquet(f"{output}/log")
    assert sorted((r["outcome"], r["count"]) for r in log.groupBy("outcome").count().collect()) == [("good", 2), ("late", 10)]
    report = latency_report(batch_log(spark, output)).first()
    assert (report.total_events, report.total_batches, report.late_events) == (12, 1, 10)
    assert report.latency_ms.p50 == report.latency_ms.max > 0
    assert report.throughput_eps > 0


def test_report_of_nothing(spark):
    report = latency_report(spark.createDataFrame([], "total_events long, late_events long, rejected_lines long, started timestamp, latency_ms double, batch long")).first()
    assert (report.total_events, report.total_batches, report.throughput_eps) == (0, 0, 0.0)
    assert tuple(report.latency_ms) == (0.0, 0.0, 0.0, 0.0)


def test_window_job(spark, feed, tmp_path):
    for s in range(0, 60, 10):
        feed.seconds(s, s + 10)
    feed.add("{broken")
    report = run_window_job(spark, str(feed.path), str(tmp_path / "out"), max_files=2).first()
    assert (report.total_events, report.total_batches) == (60, 4)
    records = spark.read.json(str(tmp_path / "out/tumbling_windows")).orderBy("window_start").collect()
    assert [r.window_start for r in records][:2] == ["2024-03-01T10:00:00+00:00", "2024-03-01T10:00:10+00:00"]
    assert records[0].aggregates.food.tx_count == records[0].aggregates.books.tx_count == 5
    assert records[0].window_size_s == 10
    sliding = spark.read.json(str(tmp_path / "out/sliding_windows")).orderBy("window_end").collect()
    assert (sliding[0].window_end, sliding[0].slide_s) == ("2024-03-01T10:00:10+00:00", 10)
    assert sliding[0].region_avg_amount.north == pytest.approx(sum(10 + s % 7 for s in range(10)) / 10)
    log = spark.read.parquet(str(tmp_path / "out/log"))
    assert [r[0] for r in log.where("outcome = 'rejected'").select("_corrupt_record").collect()] == ["{broken"]


def test_flushed_job_has_all_windows_and_later_runs_take_them_back(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    feed.seconds(0, 33)
    run_window_job(spark, str(feed.path), out, flush=True)
    table, _ = split_corrupt(read_feed(spark, str(feed.path)))
    read = lambda kind: spark.read.parquet(f"{out}/windows/{kind}").drop("batch")
    assert bag(read("tumbling")) == bag(tumbling_totals(table)) and bag(read("sliding")) == bag(sliding_average(table))
    feed.seconds(33, 57)
    run_window_job(spark, str(feed.path), out, flush=True)
    table, _ = split_corrupt(read_feed(spark, str(feed.path)))
    assert bag(read("tumbling")) == bag(tumbling_totals(table)) and bag(read("sliding")) == bag(sliding_average(table))
    records = spark.read.json(f"{out}/tumbling_windows")
    assert records.count() == records.select("window_start").distinct().count() == 6


def test_counts_more_batches_than_spark_remembers(spark, feed, tmp_path, conf):
    conf("spark.sql.streaming.numRecentProgressUpdates", "3")
    for s in range(8):
        feed.add(feed.event(s), "junk")
    ingest(stream_feed(spark, str(feed.path), max_files=1), str(tmp_path / "out")).awaitTermination()
    report = latency_report(batch_log(spark, str(tmp_path / "out"))).first()
    assert (report.total_events, report.total_batches, report.late_events) == (8, 8, 8)


def test_every_line_is_an_event_a_reject_or_blank(spark, feed):
    one = json.dumps(feed.event(0))
    bad = [f"{one} {one}", f"{one},{one}", f"{one} junk", f"{one}]", f"{one}}}", "[1]", "{}", "null", "7", '"text"', f"[{one}]",
           one.replace('"timestamp"', '"time"'), one.replace('"amount": 10.0', '"amount": null'), one.replace('"books"', "null")]
    feed.add(one, f"  {one}\t", "", " ", "\t", *bad)
    good, rejects = split_corrupt(read_feed(spark, str(feed.path)))
    assert good.count() == 2 and sorted(r.line for r in rejects.collect()) == sorted(bad)
    lines = spark.read.text(str(feed.path))
    assert lines.count() == 2 + len(bad) + lines.where(is_blank()).count()


def test_rows_without_id_time_or_key_are_kept(spark):
    rows = spark.createDataFrame([(None, None, None), (None, START, "a"), (1, START, None), (1, START, "a")], "event_id long, timestamp timestamp, category string")
    assert drop_replays(rows).count() == 3
    assert drop_late(rows, "timestamp", F.lit(START)).count() == 4
    totals = tumbling_totals(rows.withColumn("amount", F.lit(1.0)))
    record = window_record(totals, "category", ("tx_count",)).first()
    assert record.aggregates == {"(none)": 1, "a": 2}


def test_odd_amounts_are_rejects_and_the_job_goes_on(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    odd = [1e30, -1e30, float("nan"), float("inf"), 1e15]
    feed.add(feed.event(0, amount=1.5), *[feed.event(1, amount=a) for a in odd], feed.event(2, discount_pct=float("nan")))
    first = run_window_job(spark, str(feed.path), out, flush=True).first()
    assert (first.total_events, first.total_batches) == (1, 1)
    assert [r.avg_amount for r in read_windows(spark, out, "sliding").collect()] == [1.5] * 3
    feed.add(feed.event(1, amount=2.5, region=None), feed.event(3, region="(none)"), feed.event(3, region="(none)'"))
    run_window_job(spark, str(feed.path), out, flush=True)
    records = spark.read.json(f"{out}/sliding_windows").collect()
    assert all(r.region_avg_amount.asDict() == {"north": 1.5, "(none)": 2.5, "(none)'": 13.0, "(none)''": 13.0} for r in records)
    log = spark.read.parquet(f"{out}/log")
    assert log.where("outcome = 'rejected'").count() == len(odd) + 1


def test_odd_amounts_in_tables(spark):
    rows = [(START, "a", x) for x in (1.5, float("nan"), 1e30, float("inf"), None)] + [(START, "b", float("nan"))]
    df = spark.createDataFrame(rows, "timestamp timestamp, region string, amount double")
    found = {r.region: r.avg_amount for r in sliding_average(df, size_s=10).collect()}
    assert found == {"a": 1.5, "b": None}


def test_records_of_many_keys_are_split(spark):
    rows = [(1, k, i) for i, k in enumerate([None, *"abcdefg"])] + [(2, "a", 1)]
    windowed = spark.createDataFrame(rows, "w int, k string, n int")
    parts = window_record(windowed, "k", ("n",), by=("w",), most_keys=3).collect()
    assert sorted((r.w, len(r.aggregates)) for r in parts) == [(1, 2), (1, 3), (1, 3), (2, 1)]
    assert {k: v for r in parts if r.w == 1 for k, v in r.aggregates.items()} == {"(none)": 0} | {k: i for i, k in enumerate("abcdefg", 1)}


@pytest.mark.parametrize("flush", [False, True])
def test_feed_without_events(spark, tmp_path, flush):
    """A feed that is not there yet, then has no files, then blank lines only, then rejects only, then events."""
    feed, out = tmp_path / "feed", str(tmp_path / "out")
    def report():
        row = run_window_job(spark, str(feed), out, flush=flush).first()
        return row.total_events, row.total_batches
    assert report() == (0, 0)
    assert report() == (0, 0)
    (feed / "batch_0.jsonl").write_text("\n   \n\t\n")
    assert report() == (0, 1)
    (feed / "batch_1.jsonl").write_text("junk\n")
    assert report() == (0, 1)
    assert read_windows(spark, out, "tumbling").count() == 0
    event = {"event_id": 1, "timestamp": START.isoformat(), "category": "food", "amount": 2.0}
    (feed / "batch_2.jsonl").write_text(json.dumps(event) + "\n")
    assert report() == (1, 1)
    assert read_windows(spark, out, "tumbling").count() == int(flush)


def test_flush_makes_no_window_of_late_events_alone(spark, feed, tmp_path):
    """A window before the watermark without a row was never written; an event that comes after must not open it."""
    out = str(tmp_path / "out")
    feed.add(feed.event(0), feed.event(100))
    run_window_job(spark, str(feed.path), out)
    feed.add(feed.event(50), feed.event(96))
    run_window_job(spark, str(feed.path), out, flush=True)
    found = sorted((r.window_start.minute * 60 + r.window_start.second, r.tx_count) for r in read_windows(spark, out, "tumbling").collect())
    assert found == [(0, 1), (90, 1), (100, 1)]


@pytest.mark.parametrize("broken", ["counts", "records", "marker"])
def test_a_crash_between_two_writes_changes_nothing(spark, feed, tmp_path, monkeypatch, broken):
    """The job dies between log and counts, between windows and records, or before a marker, and is run again."""
    out, clean = str(tmp_path / "out"), str(tmp_path / "clean")
    place = {"counts": (feeds, "_counts"), "records": (window_job, "tumbling_records"), "marker": (window_job, "commit")}[broken]
    for s in range(0, 40, 10):
        feed.seconds(s, s + 10)
    with monkeypatch.context() as m:
        m.setattr(*place, None)  # what the job needs next is not there
        with pytest.raises(Exception):  # noqa: B017
            run_window_job(spark, str(feed.path), out, flush=True)
        assert read_windows(spark, out, "tumbling").count() == 0
        if broken == "counts":
            assert committed(spark, out, "log") == [] and batch_log(spark, out).count() == 0
    feed.seconds(40, 57)
    run_window_job(spark, str(feed.path), out, flush=True)
    run_window_job(spark, str(feed.path), clean, flush=True)
    for kind in WINDOWS:
        assert bag(read_windows(spark, out, kind)) == bag(read_windows(spark, clean, kind)) != Counter()
    assert batch_log(spark, out).agg(F.sum("total_events")).first()[0] == 57
    for kind in ("tumbling_windows", "sliding_windows"):
        assert bag(spark.read.text(f"{out}/{kind}").select("value")) == bag(spark.read.text(f"{clean}/{kind}").select("value"))


def test_compaction_is_seen_whole_or_not_at_all(spark, feed, tmp_path, monkeypatch):
    out, table = str(tmp_path / "out"), "windows/tumbling"
    for s in range(0, 60, 10):
        feed.seconds(s, s + 10)
        run_window_job(spark, str(feed.path), out, flush=s == 50)
    before = read_windows(spark, out, "tumbling")
    want = bag(before)
    with monkeypatch.context() as m:  # dies before its marker
        m.setattr("tidemill.streaming.commits.commit", None)
        with pytest.raises(TypeError):
            compact(spark, out, table, WINDOWS["tumbling"])
    assert bag(read_windows(spark, out, "tumbling")) == want
    assert compact(spark, out, table, WINDOWS["tumbling"]) is not None
    assert committed(spark, out, table) == [] and compact(spark, out, table, WINDOWS["tumbling"]) is None
    assert bag(before) == bag(read_windows(spark, out, "tumbling")) == want  # a reader that began before, and a new one
    vacuum(spark, out, table)
    assert bag(read_windows(spark, out, "tumbling")) == want
    feed.seconds(60, 75)
    run_window_job(spark, str(feed.path), out, flush=True)
    good, _ = split_corrupt(read_feed(spark, str(feed.path)))
    assert bag(read_windows(spark, out, "tumbling")) == bag(tumbling_totals(good))
    compact(spark, out, table, WINDOWS["tumbling"])
    vacuum(spark, out, table)
    assert bag(read_windows(spark, out, "tumbling")) == bag(tumbling_totals(good))


def by_loop(rows, size_s):
    """Trailing means of (id, user, second, amount) rows, and their anchored windows."""
    means, windows, current = {}, {}, {}
    for i, user, t, _ in rows:
        inside = [a for _, u, s, a in rows if u == user and t - size_s <= s <= t]
        means[i] = sum(inside) / len(inside)
    for _, user, t, amount in sorted(rows, key=lambda r: r[2]):
        if user not in current or t >= current[user] + size_s:
            current[user] = t
        n, total = windows.get((user, current[user]), (0, 0.0))
        windows[user, current[user]] = (n + 1, total + amount)
    return means, windows


def test_ordered_streams_with_disorder_late_rows_and_restart(spark, feed, tmp_path):
    """Events come out of order within the delay; some later than that; the query is stopped after each batch."""
    rng, rows = random.Random(4), []
    late = (5, 6, 60)
    for first in range(0, 120, 30):
        batch = [feed.event(s, user_id=rng.choice([1, 1, 2, 3, None]), amount=float(rng.randrange(100))) for s in range(first, first + 30) if s not in late]
        if first == 90:
            batch += [feed.event(s, user_id=1, amount=1e6) for s in late]
        rng.shuffle(batch)
        feed.add(*batch)
        rows += [(e["event_id"], e["user_id"], (dt.datetime.fromisoformat(e["timestamp"]) - START).seconds, e["amount"]) for e in batch if e["amount"] < 1e6]
        trailing = run(spark, trailing_stream(events(spark, feed), 20), tmp_path, "trailing")
        anchored = run(spark, anchored_stream(events(spark, feed), 20), tmp_path, "anchored")
    means, windows = by_loop(rows, 20)
    passed = 119 - 5
    second = lambda t: (t.astimezone(dt.timezone.utc) - START).total_seconds()
    assert {r.event_id: r.trailing_avg for r in trailing.collect()} == pytest.approx({i: means[i] for i, _, t, _ in rows if t <= passed})
    got = {(r.user_id, second(r.window_start)): (r.tx_count, r.total_amount) for r in anchored.collect()}
    assert got == {k: v for k, v in windows.items() if k[1] + 20 <= passed}


def test_files_are_taken_by_name(spark, tmp_path):
    """Later names have earlier modification times; a folder may be empty or missing; read files may go away."""
    root, progress = tmp_path / "feed", str(tmp_path / "progress")
    seen = []

    def take(most=None):
        stream = stream_named(spark, str(root), progress, max_files=most)

        def write(batch, _):
            if rows := [(r.file, r.event_id) for r in batch.collect()]:
                seen.append(sorted(rows, key=repr))

        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", progress).start()
        query.processAllAvailable()
        query.stop()

    def add(*numbers):
        for i in numbers:
            event = {"event_id": i, "timestamp": START.isoformat(), "category": "food", "amount": 2.0}
            path = root / f"batch_{i:03d}.jsonl"
            path.write_text(json.dumps(event) + "\n\n" + "junk\n")
            os.utime(path, (1_700_000_000 - i,) * 2)

    take()
    assert seen == []
    root.mkdir()
    take()
    add(7, 3, 5)
    (root / "other.txt").write_text("x")
    take(2)
    names = [[f for f, _ in batch if f] for batch in seen]
    assert names == [["batch_003.jsonl"] * 2 + ["batch_005.jsonl"] * 2, ["batch_007.jsonl"] * 2]
    add(4)  # under a name that has been passed
    for i in (3, 5, 7):
        (root / f"batch_{i:03d}.jsonl").unlink()
    take()
    add(8, 9)
    take(1)
    assert [sorted({f for f, _ in batch}) for batch in seen[2:]] == [["batch_008.jsonl"], ["batch_009.jsonl"]]
    assert [i for batch in seen for _, i in batch if i is not None] == [3, 5, 7, 8, 9]


def test_sliding_stream_counts_events_once(spark, feed, tmp_path):
    for s in range(0, 60, 10):
        feed.seconds(s, s + 10)
    query = drain(sliding_stream(events(spark, feed)), str(tmp_path / "s"), str(tmp_path / "p"))
    panes, windows = query.lastProgress["stateOperators"][-1], query.lastProgress["stateOperators"][0]
    updated = sum(p["stateOperators"][-1]["numRowsUpdated"] for p in query.recentProgress)
    assert updated <= 60 and {panes["operatorName"], windows["operatorName"]} == {"stateStoreSave"}


def test_open_windows_in_the_state(spark, feed, tmp_path):
    feed.seconds(0, 33)
    stream = tumbling_stream(events(spark, feed))
    run(spark, stream, tmp_path, "w")
    feed.seconds(33, 47)
    written = run(spark, stream, tmp_path, "w")
    held = open_windows(spark, str(tmp_path / "w-progress"))
    good, _ = split_corrupt(read_feed(spark, str(feed.path)))
    assert bag(written) + bag(held) == bag(tumbling_totals(good)) and held.count() == 2


def test_command_line(spark, feed, tmp_path, capsys):
    feed.seconds(0, 30)
    main(["windows", "--input", str(feed.path), "--output", str(tmp_path / "w"), "--late", "processing-time"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["late_events"] == 30
    good, _ = split_corrupt(read_feed(spark, str(feed.path)))
    table = good.withColumnRenamed("event_id", "transaction_id").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    table.write.parquet(str(tmp_path / "tx"))
    main(["features", "--input", str(tmp_path / "tx"), "--output", str(tmp_path / "f")])
    assert len(spark.read.parquet(str(tmp_path / "f")).columns) == 44
