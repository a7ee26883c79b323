"""The windowed view of an event feed as one restartable job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemill.functions import iso_text
from tidemill.operators import sliding_average, tumbling_totals, window_record
from tidemill.sources import EVENT, FEED_FILES, delete_path, make_folder, stream_feed
from tidemill.streaming import (
    OPEN,
    batch_log,
    commit,
    ingest,
    last_batch,
    latency_report,
    logged_schema,
    read_committed,
    sliding_stream,
    tumbling_stream,
    withdraw,
)

WATERMARK, PROCESSING_TIME = "watermark", "processing-time"

#: Of the rows that the job writes for closed windows.
WINDOWS = {
    "tumbling": "window_start timestamp, window_end timestamp, category string, tx_count long, total_amount double",
    "sliding": "window_start timestamp, window_end timestamp, region string, avg_amount double",
}


def read_windows(spark: SparkSession, output: str, kind: str) -> DataFrame:
    """The windows of a kind that the job has written, of whole micro-batches only."""
    return read_committed(spark, output, f"windows/{kind}", WINDOWS[kind])


# The field names of the published window records.


def tumbling_records(windows: DataFrame, size_s: int) -> DataFrame:
    records = window_record(windows, "category", ("tx_count", "total_amount"))
    return records.select(
        iso_text(F.col("window_start")).alias("window_start"), F.lit(size_s).alias("window_size_s"), "aggregates"
    )


def sliding_records(windows: DataFrame, size_s: int, slide_s: int) -> DataFrame:
    records = window_record(windows, "region", ("avg_amount",), "region_avg_amount")
    return records.select(
        iso_text(F.col("window_end")).alias("window_end"),
        F.lit(size_s).alias("window_size_s"),
        F.lit(slide_s).alias("slide_s"),
        "region_avg_amount",
    )


def _logged_events(reader, output: str) -> DataFrame:
    """The good events of the log; ``reader`` is a session's ``read`` or ``readStream``."""
    rows = reader.schema(logged_schema(EVENT)).parquet(f"{output}/log")
    return rows.where(F.col("outcome") == "good").select(*EVENT.names)


def _write(windows: DataFrame, output: str, kind: str, batch: int | str, records: Callable[[DataFrame], DataFrame]) -> None:
    """One folder of windows, as rows and as records. They count when both are whole."""
    spark, tables = windows.sparkSession, (f"windows/{kind}", f"{kind}_windows")
    for table in tables:
        withdraw(spark, output, table, batch)
    path = f"{output}/{tables[0]}/batch={batch}"
    windows.write.mode("overwrite").parquet(path)
    records(spark.read.schema(windows.schema).parquet(path)).write.mode("overwrite").json(f"{output}/{tables[1]}/batch={batch}")
    for table in tables:
        commit(spark, output, table, batch)


def _emit(stream: DataFrame, output: str, kind: str, records: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Write the windows that close, as rows and as records, in one folder for each micro-batch.

    A window closes in one micro-batch, with all its keys, so records are whole and nothing written is touched again.
    """

    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: _write(batch, output, kind, batch_id, records))
        .outputMode("append")
        .option("checkpointLocation", f"{output}/progress/{kind}")
        .trigger(availableNow=True)
        .start()
    )


def _flush(spark: SparkSession, output: str, kind: str, windows: Callable[[DataFrame], DataFrame], reach_s: int, watermark_s: float, records) -> None:
    """Write the windows that are still open: those that the watermark has not passed.

    No event of such a window was ever late, so it has all the logged ones. A window that it has passed is not made again,
    whether it was written or, as all its events came too late, was not.
    """
    events = _logged_events(spark.read, output)
    latest = events.agg(F.max(F.unix_millis("timestamp"))).first()[0]  # the watermark counts whole milliseconds
    if latest is not None:
        passed = F.timestamp_millis(F.lit(latest - round(watermark_s * 1000)))
        near = events.where(F.col("timestamp") >= passed - F.make_dt_interval(secs=F.lit(reach_s)))
        _write(windows(near).where(F.col("window_end") > passed), output, kind, OPEN, records)


def run_window_job(
    spark: SparkSession,
    feed: str,
    output: str,
    window_s: int = 10,
    watermark_s: float = 5.0,
    late: str = WATERMARK,
    files: str = FEED_FILES,
    max_files: int | None = None,
    flush: bool = False,
    arrival: Column | None = None,
) -> DataFrame:
    """Bring the windows of a feed up to date and return the latency report of this run.

    The feed is read and parsed once. Under ``output``, ``log/`` holds its rows by micro-batch and outcome, ``batches/``
    counts them, and ``progress/`` has the checkpoints: run again, the job reads new files only and goes on with the
    windows that were open. Both kinds of windows, tumbling and sliding (three times the size, one slide for each tumbling
    window), are made from the same logged events. ``windows/<kind>/`` gets one row for each closed window and key, and
    ``<kind>_windows/`` one JSON record for each closed window, in a new folder for each micro-batch; what earlier runs
    wrote is not read. ``latency_report/`` is written anew. A folder counts once its marker is written (see
    ``read_windows``, ``compact``). A feed that has no files yet, or only blank lines, gives an empty report; its folder is made
    if it does not exist.

    A window is closed once the watermark, ``watermark_s`` behind the latest event, has passed its end. With ``flush``,
    for a feed that is finished, the windows still open are written as well; a later run takes them back first.
    With ``late="processing-time"`` an event that arrives more than ``watermark_s`` after it happened is dropped. Late
    events are counted either way.
    """
    size_s, slide_s = 3 * window_s, window_s
    for kind in WINDOWS:
        for table in (f"windows/{kind}", f"{kind}_windows"):
            withdraw(spark, output, table, OPEN)
            delete_path(spark, f"{output}/{table}/batch={OPEN}")
            make_folder(spark, f"{output}/{table}")
    for path in (feed, f"{output}/log"):
        make_folder(spark, path)
    before = last_batch(spark, output)
    lines = stream_feed(spark, feed, files=files, max_files=max_files)
    ingest(lines, output, watermark_s, late == PROCESSING_TIME, arrival).awaitTermination()

    events = _logged_events(spark.readStream, output)
    kinds = {
        "tumbling": (
            tumbling_stream(events, window_s, watermark_s),
            lambda rows: tumbling_totals(rows, size_s=window_s),
            window_s,
            lambda rows: tumbling_records(rows, window_s),
        ),
        "sliding": (
            sliding_stream(events, size_s, slide_s, watermark_s),
            lambda rows: sliding_average(rows, size_s=size_s, slide_s=slide_s),
            size_s,
            lambda rows: sliding_records(rows, size_s, slide_s),
        ),
    }
    running = [_emit(stream, output, kind, records) for kind, (stream, _, _, records) in kinds.items()]
    try:
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:
            query.stop()
    if flush:
        for kind, (_, windows, reach_s, records) in kinds.items():
            _flush(spark, output, kind, windows, reach_s, watermark_s, records)
    report = latency_report(batch_log(spark, output, before))
    report.write.mode("overwrite").json(f"{output}/latency_report")
    return report
