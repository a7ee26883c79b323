"""Named queries over the driver's tables, each built from the library's operators.

Doubles are rounded where results are compared between engines, as sums depend on the order of addition.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import iso_text, parse_iso, shed_and_round
from tidemill.operators import (
    attach_by_key,
    anchored_tumbling,
    approx_percentiles,
    drop_late,
    drop_replays,
    exact_percentiles,
    flag_late,
    lateness_summary,
    merged_percentiles,
    moments,
    percentile_sketches,
    row_count,
    skip_processed,
    sliding_average,
    split_corrupt,
    throughput,
    trailing_average,
    tumbling_totals,
    window_pivot,
    window_record,
    with_entity_summary,
    with_interactions,
    with_log_features,
    with_time_features,
    with_zscores,
)
from tidemill.plans.features import LOGGED, NORMALISED, bucketed_features, feature_table, with_flags
from tidemill.plans.views import (
    EVENT_TYPES,
    PRIORITIES,
    SEGMENTS,
    arrivals,
    event_transactions,
    order_transactions,
    table,
)
from tidemill.plans.windows import read_windows, run_window_job
from tidemill.sources import (
    EVENT,
    feed_lines,
    is_blank,
    read_dated,
    read_feed,
    read_transactions,
    scratch_path,
    staged,
    stream_feed,
    stream_named,
    write_bucketed,
    write_dated,
    write_table,
)
from tidemill.streaming import (
    anchored_stream,
    batch_log,
    deduplicated_stream,
    drain,
    open_windows,
    sliding_stream,
    trailing_stream,
    tumbling_stream,
)

Query = Callable[[SparkSession, str], DataFrame]

HOUR = 3600
USER_FEATURES = (
    "user_tx_count",
    "user_total_spend",
    "user_avg_amount",
    "user_std_amount",
    "user_avg_items",
    "user_return_rate",
    "user_avg_session",
)


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: shed_and_round(F.col(n), digits) for n in names})


def time_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_transactions(spark, sf).transform(with_time_features)
    cyclic = ("hour_sin", "hour_cos", "dow_sin", "dow_cos")
    return _rounded(rows, 6, *cyclic).select("transaction_id", "hour", "day_of_week", *cyclic)


def log_transforms(spark: SparkSession, sf: str) -> DataFrame:
    logs = [f"log_{c}" for c in LOGGED]
    rows = event_transactions(spark, sf).transform(with_log_features, LOGGED)
    return _rounded(rows, 6, *logs).select("transaction_id", *logs)


def categorical_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_transactions(spark, sf).transform(with_flags, EVENT_TYPES)
    return rows.select("transaction_id", *[c for c in rows.columns if c.startswith(("cat_", "dev_"))])


def interaction_features(spark: SparkSession, sf: str) -> DataFrame:
    ratios = ("spend_per_item", "spend_per_view", "net_amount")
    rows = event_transactions(spark, sf).transform(with_interactions)
    return _rounded(rows, 4, *ratios).select("transaction_id", *ratios)


def _user_features_rounded(rows: DataFrame) -> DataFrame:
    rows = _rounded(rows, 4, "user_avg_amount", "user_avg_items", "user_return_rate", "user_avg_session")
    return _rounded(rows, 2, "user_total_spend", "user_std_amount")


def user_aggregations(spark: SparkSession, sf: str) -> DataFrame:
    used = ("transaction_id", "user_id", "amount", "items_in_cart", "is_returned", "session_duration")
    joined = staged(order_transactions(spark, sf).select(*used), "orders")  # both uses read the join's result
    return _user_features_rounded(joined.transform(with_entity_summary)).select("transaction_id", "user_id", "amount", "items_in_cart", *USER_FEATURES)


def global_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = moments(order_transactions(spark, sf), NORMALISED)
    return _rounded(stats, 4, *stats.columns)


def zscore_features(spark: SparkSession, sf: str) -> DataFrame:
    scores = [f"{c}_zscore" for c in NORMALISED]
    joined = staged(order_transactions(spark, sf).select("transaction_id", "user_id", *NORMALISED), "orders")
    rows = joined.transform(with_zscores, NORMALISED)
    return _rounded(rows, 6, *scores).select("transaction_id", "user_id", *scores)


def _features_rounded(rows: DataFrame) -> DataFrame:
    rows = _user_features_rounded(rows)
    rows = _rounded(rows, 4, "spend_per_item", "spend_per_view", "net_amount")
    return _rounded(
        rows,
        6,
        *("hour_sin", "hour_cos", "dow_sin", "dow_cos"),
        *[f"log_{c}" for c in LOGGED],
        *[f"{c}_zscore" for c in NORMALISED],
    )


def event_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return _features_rounded(feature_table(event_transactions(spark, sf), EVENT_TYPES))


def order_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    transactions = staged(order_transactions(spark, sf), "orders")
    return _features_rounded(feature_table(transactions, SEGMENTS, PRIORITIES))


def count_rows(spark: SparkSession, sf: str) -> DataFrame:
    return row_count(table(spark, sf, "lineitem"))


def iso_timestamp_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    text = event_transactions(spark, sf).select("transaction_id", iso_text(F.col("timestamp")).alias("iso"))
    return text.withColumn("instant", parse_iso(F.col("iso")).cast("timestamp_ntz"))


def late_events_flagged(spark: SparkSession, sf: str) -> DataFrame:
    events = arrivals(event_transactions(spark, sf)).transform(flag_late, "timestamp", F.col("arrival_ts"))
    return events.select("transaction_id", "timestamp", "arrival_ts", "is_late")


def late_events_dropped(spark: SparkSession, sf: str) -> DataFrame:
    events = arrivals(event_transactions(spark, sf)).transform(drop_late, "timestamp", F.col("arrival_ts"))
    return events.select("transaction_id", "timestamp", "amount")


def late_rate_by_key(spark: SparkSession, sf: str) -> DataFrame:
    events = arrivals(event_transactions(spark, sf)).transform(flag_late, "timestamp", F.col("arrival_ts"))
    return _rounded(lateness_summary(events, "is_late", ["category"]), 6, "late_rate")


def tumbling_category(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(tumbling_totals(event_transactions(spark, sf), size_s=HOUR), 2, "total_amount")


def sliding_region_avg(spark: SparkSession, sf: str) -> DataFrame:
    return sliding_average(event_transactions(spark, sf), size_s=3 * HOUR, slide_s=HOUR)


def trailing_avg_by_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = trailing_average(event_transactions(spark, sf), size_s=3 * HOUR, pane_s=HOUR)
    return _rounded(rows, 4, "trailing_avg").select("transaction_id", "user_id", "timestamp", "trailing_avg")


def anchored_tumbling_by_user(spark: SparkSession, sf: str) -> DataFrame:
    windows = anchored_tumbling(event_transactions(spark, sf), size_s=6 * HOUR, rows_per_segment=1024)
    return _rounded(windows, 2, "total_amount")


def window_category_pivot(spark: SparkSession, sf: str) -> DataFrame:
    windows = tumbling_totals(event_transactions(spark, sf), size_s=HOUR)
    wide = window_pivot(windows, "category", EVENT_TYPES, ("tx_count", "total_amount"))
    return _rounded(wide, 2, *[f"{c}_total_amount" for c in EVENT_TYPES])


def window_category_record(spark: SparkSession, sf: str) -> DataFrame:
    """The nested record, read back entry by entry so that it can be compared."""
    windows = tumbling_totals(event_transactions(spark, sf), size_s=HOUR)
    records = window_record(windows, "category", ("tx_count", "total_amount"))
    entries = records.select("window_start", "window_end", F.explode("aggregates").alias("category", "of"))
    return _rounded(entries.select("window_start", "window_end", "category", "of.*"), 2, "total_amount")


def window_region_record(spark: SparkSession, sf: str) -> DataFrame:
    windows = sliding_average(event_transactions(spark, sf), size_s=3 * HOUR, slide_s=HOUR)
    records = window_record(windows, "region", ("avg_amount",), "region_avg_amount")
    return records.select("window_start", "window_end", F.explode("region_avg_amount").alias("region", "avg_amount"))


def latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    events = arrivals(event_transactions(spark, sf))
    latency = F.unix_micros(F.col("arrival_ts").cast("timestamp")) - F.unix_micros(F.col("timestamp").cast("timestamp"))
    return exact_percentiles(events.select((latency / 1000).alias("latency_ms")), "latency_ms")


def amount_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    found = exact_percentiles(order_transactions(spark, sf), "amount", (1, 25, 50, 75, 95, 99), ["category"])
    return _rounded(found, 4, "p1", "p25", "p50", "p75", "p95", "p99")


def approx_amount_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each approximate percentile is within the sketch's rank error: of the n values of its group, no more than
    rank + n / accuracy are smaller, and no fewer than rank - n / accuracy are not larger.
    """
    accuracy, percents = 1_000, (50, 95, 99)
    rows = staged(order_transactions(spark, sf).select("category", "amount"), "orders")
    found = approx_percentiles(rows, "amount", percents, ["category"], accuracy)
    sizes = rows.groupBy("category").agg(F.count("amount").alias("n"))
    known = attach_by_key(rows, found.join(sizes, "category").withColumn("rows", F.col("n")), ["category"], "rows")
    sums = [F.sum((F.col("amount") < F.col(f"p{p}")).cast("long")).alias(f"below{p}") for p in percents]
    sums += [F.sum((F.col("amount") <= F.col(f"p{p}")).cast("long")).alias(f"upto{p}") for p in percents]
    counted = known.groupBy("category", "n").agg(*sums)
    slack = F.col("n") / accuracy + 1

    def within(p: int) -> Column:
        rank = F.col("n") * p / 100
        return ((F.col(f"below{p}") <= rank + slack) & (F.col(f"upto{p}") >= rank - slack)).alias(f"p{p}_within")

    return counted.select("category", "n", *[within(p) for p in percents])


def divided_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """As ``amount_percentiles``, with every group of more than 100 values divided, as only very large ones are otherwise."""
    found = exact_percentiles(order_transactions(spark, sf), "amount", (1, 25, 50, 75, 95, 99), ["category"], min_split=100)
    return _rounded(found, 4, "p1", "p25", "p50", "p75", "p95", "p99")


def throughput_by_key(spark: SparkSession, sf: str) -> DataFrame:
    rates = throughput(event_transactions(spark, sf), "timestamp", ["category"])
    return _rounded(rates, 8, "events_per_second")


def dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    """The log delivered twice, with copies dropped."""
    events = event_transactions(spark, sf).select("transaction_id", "user_id", "timestamp", "amount")
    return drop_replays(events.unionByName(events), "transaction_id")


def unprocessed_batches_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the hourly batches that were not complete when a consumer stopped on January 15th."""
    events = event_transactions(spark, sf).withColumn(
        "batch", F.date_format("timestamp", "'batch_'yyyyMMddHH'.jsonl'")
    )
    stopped = F.lit("2024-01-15 12:30:00").cast("timestamp_ntz")
    processed = events.groupBy("batch").agg(F.max("timestamp").alias("last")).where(F.col("last") < stopped)
    return skip_processed(events, processed, "batch").select("transaction_id", "batch", "amount")


def partition_pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "dated")
    write_dated(event_transactions(spark, sf), path)
    days = read_dated(spark, path, "2024-01-10", "2024-01-19")
    daily = days.groupBy("event_date", "category").agg(
        F.count(F.lit(1)).alias("tx_count"), F.sum("amount").alias("total_amount")
    )
    return _rounded(daily, 2, "total_amount")


_STAGED = "part-*"


def _zoneless(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _slices(events: DataFrame, parts: int = 3) -> list[DataFrame]:
    """The events in stretches of equal time, one after the other."""
    seconds = F.unix_micros(F.col("timestamp").cast("timestamp"))
    first, last = events.agg(F.min(seconds), F.max(seconds)).first()
    place = F.least(F.floor((seconds - first) * parts / F.lit(float(last - first + 1))), F.lit(parts - 1))
    return [events.where(place == i) for i in range(parts)]


def _drained_in_parts(spark: SparkSession, build: Callable[[DataFrame], DataFrame], parts: list[DataFrame]) -> DataFrame:
    """What a streaming query writes if it is stopped after each part of its feed and started again."""
    feed, path, progress = (scratch_path(spark, name) for name in ("feed", "sink", "progress"))
    for part in parts:
        feed_lines(part.withColumnRenamed("transaction_id", "event_id")).write.mode("append").text(feed)
        stream = build(split_corrupt(stream_feed(spark, feed, EVENT, _STAGED))[0])
        drain(stream, path, progress)
    return spark.read.schema(stream.schema).parquet(path)


def stream_tumbling_category(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that the watermark has passed when the feed has been read to its end."""
    parts = _slices(event_transactions(spark, sf))
    windows = _drained_in_parts(spark, lambda events: tumbling_stream(events, size_s=HOUR), parts)
    return _rounded(_zoneless(windows, "window_start", "window_end"), 2, "total_amount")


def stream_sliding_region_avg(spark: SparkSession, sf: str) -> DataFrame:
    parts = _slices(event_transactions(spark, sf))
    windows = _drained_in_parts(spark, lambda events: sliding_stream(events, size_s=3 * HOUR, slide_s=HOUR), parts)
    return _zoneless(windows, "window_start", "window_end")


def stream_dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    """A feed that sends every event twice in its part and again with the next part, written once each."""
    parts, sent = _slices(event_transactions(spark, sf)), []
    for i, part in enumerate(parts):
        sent.append(part.unionByName(part) if i == 0 else part.unionByName(part).unionByName(parts[i - 1]))
    unique = _drained_in_parts(spark, deduplicated_stream, sent)
    return _zoneless(unique, "timestamp").select("event_id", "user_id", "timestamp", "amount")


def _window_job(spark: SparkSession, sf: str, arrival: Column | None = None) -> str:
    """The window job, stopped after each part of a feed and started again; returns its folder."""
    feed, output = scratch_path(spark, "feed"), scratch_path(spark, "windows")
    parts = _slices(event_transactions(spark, sf))
    for i, part in enumerate(parts):
        feed_lines(part.withColumnRenamed("transaction_id", "event_id")).write.mode("append").text(feed)
        run_window_job(spark, feed, output, HOUR, files=_STAGED, flush=i == len(parts) - 1, arrival=arrival)
    return output


def stream_restart_windows(spark: SparkSession, sf: str) -> DataFrame:
    """All windows of a feed that was read in parts and then finished."""
    rows = read_windows(spark, _window_job(spark, sf), "tumbling")
    return _rounded(_zoneless(rows, "window_start", "window_end"), 2, "total_amount")


def stream_late_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Events and late events that the job counted, where an event arrives 0 to 10 seconds after it happened."""
    arrival = F.col("timestamp") + F.make_dt_interval(secs=F.pmod("event_id", F.lit(11)))
    log = batch_log(spark, _window_job(spark, sf, arrival))
    return log.agg(*[F.sum(c).alias(c) for c in ("total_events", "late_events", "rejected_lines")])


def feed_conservation(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of each line of a feed with blank, tab, doubled, trailed and timeless lines, and amounts that are none, among good ones."""
    events = event_transactions(spark, sf).withColumnRenamed("transaction_id", "event_id")
    kind = F.pmod("event_id", F.lit(10))
    value = F.col("value")
    damaged = (
        F.when(kind == 0, "   ")
        .when(kind == 1, "\t")
        .when(kind == 2, F.concat(value, F.lit(" "), value))
        .when(kind == 3, F.concat(value, F.lit(" junk")))
        .when(kind == 4, F.regexp_replace(value, '"timestamp":"[^"]*",', ""))
        .when(kind == 5, F.regexp_replace(value, '"amount":[^,]*', '"amount":1e30'))
        .when(kind == 6, F.regexp_replace(value, '"amount":[^,]*', '"amount":NaN'))
        .otherwise(value)
    )
    lines = events.withColumn("timestamp", iso_text(F.col("timestamp")))
    lines = lines.select("event_id", F.to_json(F.struct(*events.columns)).alias("value"))
    path = scratch_path(spark, "feed")
    lines.select(damaged.alias("value")).write.text(path)
    text = spark.read.text(path)
    good, rejects = split_corrupt(read_feed(spark, path, EVENT, _STAGED))
    counted = [("lines", text), ("blank", text.where(is_blank())), ("good", good), ("rejected", rejects)]
    one = [df.agg(F.count(F.lit(1)).alias("line_count")).select(F.lit(name).alias("outcome"), "line_count") for name, df in counted]
    return reduce(DataFrame.unionByName, one)


def stream_anchored_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows anchored at events, of a feed read in parts: those whose end the watermark has passed."""
    parts = _slices(event_transactions(spark, sf))
    windows = _drained_in_parts(spark, lambda events: anchored_stream(events, size_s=6 * HOUR), parts)
    return _rounded(_zoneless(windows, "window_start"), 2, "total_amount")


def stream_trailing_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Trailing averages of a feed read in parts, of which some events come two parts late and are dropped."""
    parts = _slices(event_transactions(spark, sf))
    late = F.pmod("transaction_id", F.lit(50)) == 0
    sent = [parts[0].where(~late), parts[1], parts[2].unionByName(parts[0].where(late))]
    rows = _drained_in_parts(spark, lambda events: trailing_stream(events, size_s=3 * HOUR), sent)
    return _rounded(_zoneless(rows, "timestamp"), 4, "trailing_avg")


def stream_open_windows(spark: SparkSession, sf: str) -> DataFrame:
    """What the state of a windowed query holds after two of three parts of its feed, the second after a restart."""
    feed, path, progress = (scratch_path(spark, name) for name in ("feed", "sink", "progress"))
    for part in _slices(event_transactions(spark, sf))[:2]:
        feed_lines(part.withColumnRenamed("transaction_id", "event_id")).write.mode("append").text(feed)
        drain(tumbling_stream(split_corrupt(stream_feed(spark, feed, EVENT, _STAGED))[0], size_s=HOUR), path, progress)
    return _rounded(_zoneless(open_windows(spark, progress), "window_start", "window_end"), 2, "total_amount")


def _named_files(spark: SparkSession, lines: DataFrame, path: str) -> None:
    """One file for each ``name``, the last name first and with modification times that fall with the name."""
    by_name = scratch_path(spark, "by-name")
    lines.repartition("name").write.partitionBy("name").text(by_name)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(by_name).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(hadoop.Path(path))
    folders = [s.getPath() for s in fs.listStatus(hadoop.Path(by_name)) if s.isDirectory()]
    for place, folder in enumerate(sorted(folders, key=lambda f: f.getName(), reverse=True)):
        part = next(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
        target = hadoop.Path(f"{path}/{folder.getName().removeprefix('name=')}")
        fs.rename(part, target)
        fs.setTimes(target, 1_700_000_000_000 + 1000 * place, -1)


def stream_name_order(spark: SparkSession, sf: str) -> DataFrame:
    """Of each file of a feed its events, and how many files the micro-batches before its own had: five each, by name.

    The feed has a file for each day, older the later the day. Ten are there at first; the others come before a restart.
    """
    feed, out, progress = (scratch_path(spark, name) for name in ("feed", "out", "progress"))
    events = event_transactions(spark, sf).withColumnRenamed("transaction_id", "event_id")
    name = F.date_format("timestamp", "'batch_'yyyyMMdd'.jsonl'")
    lines = staged(events.select(name.alias("name"), F.to_json(F.struct(*[c if c != "timestamp" else iso_text(F.col(c)).alias(c) for c in events.columns])).alias("value")), "lines")
    tenth = [r[0] for r in lines.select("name").distinct().orderBy("name").limit(10).collect()][-1]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("file").agg(F.count(F.lit(1)).alias("events")).withColumn("number", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/part={batch_id}")

    for days in (lines.where(F.col("name") <= tenth), lines.where(F.col("name") > tenth)):
        _named_files(spark, days, feed)
        stream = split_corrupt(stream_named(spark, feed, progress, max_files=5))[0]
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", progress).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    seen = spark.read.schema("file string, events long, number int").parquet(out)
    before = seen.alias("a").join(seen.select(F.col("number").alias("earlier")), F.col("earlier") < F.col("number"), "left")
    return before.groupBy("file", "events").agg(F.count("earlier").alias("files_before"))


def merged_percentile_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Whether percentiles from sketches, stored for each day and merged, keep to 1 % of rank."""
    percents = (50, 95, 99)
    rows = staged(order_transactions(spark, sf).select("category", "timestamp", "amount"), "orders")
    daily = staged(percentile_sketches(rows, "amount", ["category", "timestamp"]), "sketches")
    found = merged_percentiles(daily, percents, ["category"])
    known = rows.join(F.broadcast(found), "category")  # a row for each category
    sums = [F.sum((F.col("amount") < F.col(f"p{p}")).cast("long")).alias(f"below{p}") for p in percents]
    sums += [F.sum((F.col("amount") <= F.col(f"p{p}")).cast("long")).alias(f"upto{p}") for p in percents]
    counted = known.groupBy("category", "n").agg(*sums)
    slack = F.col("n") / 100 + 1
    within = [((F.col(f"below{p}") <= F.col("n") * p / 100 + slack) & (F.col(f"upto{p}") >= F.col("n") * p / 100 - slack)).alias(f"p{p}_within") for p in percents]
    return counted.select("category", "n", *within)


def bucketed_user_features(spark: SparkSession, sf: str) -> DataFrame:
    """User features from a table that is bucketed by user: neither the aggregate nor the join shuffles it again."""
    used = ("transaction_id", "user_id", "amount", "items_in_cart", "is_returned", "session_duration")
    name = f"transactions_{uuid.uuid4().hex}"
    write_bucketed(order_transactions(spark, sf).select(*used), name, buckets=8, path=scratch_path(spark, "bucketed"))
    rows = bucketed_features(spark.table(name))
    return _user_features_rounded(rows).select("transaction_id", "user_id", "amount", "items_in_cart", *USER_FEATURES)


def repartitioned_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A table written, read again dealt into seven partitions, and counted by category over those that have rows."""
    path = scratch_path(spark, "table")
    write_table(event_transactions(spark, sf), path)
    rows = read_transactions(spark, path, 7, schema=event_transactions(spark, sf).schema).withColumn("part", F.spark_partition_id())
    by = rows.groupBy("category").agg(F.count(F.lit(1)).alias("tx_count"), F.countDistinct("part").alias("partitions"))
    return by


def overwritten_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table that was written and then written over with the rows of one category less."""
    path = scratch_path(spark, "table")
    events = event_transactions(spark, sf)
    write_table(events, path)
    write_table(events.where(F.col("category") != "error"), path)
    return read_transactions(spark, path, schema=events.schema).select("transaction_id", "category", "amount", "timestamp")


def _damaged_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A feed whose error events were cut off in the middle of their line."""
    events = event_transactions(spark, sf).withColumnRenamed("transaction_id", "event_id")
    lines = feed_lines(events).withColumn("broken", F.col("value").contains('"category":"error"'))
    cut = F.when(F.col("broken"), F.col("value").substr(F.lit(1), F.length("value") - 20)).otherwise(F.col("value"))
    path = scratch_path(spark, "feed")
    lines.select(cut.alias("value")).write.text(path)
    return read_feed(spark, path, EVENT, _STAGED)


def corrupt_lines_kept_apart(spark: SparkSession, sf: str) -> DataFrame:
    good, rejects = split_corrupt(_damaged_feed(spark, sf))
    parsed = good.groupBy("category").agg(F.count(F.lit(1)).alias("line_count"), F.sum("amount").alias("total_amount"))
    refused = rejects.agg(F.count(F.lit(1)).alias("line_count")).select(
        F.lit("(rejected)").alias("category"), "line_count", F.lit(None).cast("double").alias("total_amount")
    )
    return _rounded(parsed.unionByName(refused), 2, "total_amount")


QUERIES: dict[str, Query] = {
    "time_features": time_features,
    "log_transforms": log_transforms,
    "categorical_flags": categorical_flags,
    "interaction_features": interaction_features,
    "user_aggregations": user_aggregations,
    "global_stats": global_stats,
    "zscore_features": zscore_features,
    "feature_table": event_feature_table,
    "order_feature_table": order_feature_table,
    "row_count": count_rows,
    "iso_timestamp_roundtrip": iso_timestamp_roundtrip,
    "late_events_flagged": late_events_flagged,
    "late_events_dropped": late_events_dropped,
    "late_rate_by_key": late_rate_by_key,
    "tumbling_category": tumbling_category,
    "sliding_region_avg": sliding_region_avg,
    "trailing_avg_by_key": trailing_avg_by_key,
    "anchored_tumbling_by_user": anchored_tumbling_by_user,
    "window_category_pivot": window_category_pivot,
    "window_category_record": window_category_record,
    "window_region_record": window_region_record,
    "latency_percentiles": latency_percentiles,
    "amount_percentiles": amount_percentiles,
    "divided_percentiles": divided_percentiles,
    "approx_amount_percentiles": approx_amount_percentiles,
    "throughput_by_key": throughput_by_key,
    "dedup_events": dedup_events,
    "unprocessed_batches_anti": unprocessed_batches_anti,
    "partition_pruned_scan": partition_pruned_scan,
    "stream_tumbling_category": stream_tumbling_category,
    "stream_sliding_region_avg": stream_sliding_region_avg,
    "stream_dedup_events": stream_dedup_events,
    "stream_restart_windows": stream_restart_windows,
    "stream_late_accounting": stream_late_accounting,
    "feed_conservation": feed_conservation,
    "corrupt_lines_kept_apart": corrupt_lines_kept_apart,
    "stream_anchored_windows": stream_anchored_windows,
    "stream_trailing_avg": stream_trailing_avg,
    "stream_open_windows": stream_open_windows,
    "stream_name_order": stream_name_order,
    "merged_percentile_sketches": merged_percentile_sketches,
    "bucketed_user_features": bucketed_user_features,
    "repartitioned_scan": repartitioned_scan,
    "overwritten_table": overwritten_table,
}
