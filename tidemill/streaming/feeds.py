"""Streaming queries over an event feed. The window operators are those used on tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidemill.operators import sliding_average, tumbling_totals
from tidemill.operators.quality import CORRUPT, is_late
from tidemill.streaming.commits import commit, withdraw
from tidemill.streaming.reports import BATCHES

DELAY_S = 5.0


def watermarked(events: DataFrame, ts: str = "timestamp", delay_s: float = DELAY_S) -> DataFrame:
    return events.withWatermark(ts, f"{round(delay_s * 1000)} milliseconds")


def accepted(arrival_late: bool) -> Column:
    """Where an event goes: rejected (malformed), late (dropped, if late events are), or good."""
    late = F.coalesce(F.col("is_late"), F.lit(False)) & F.lit(arrival_late)
    return F.when(F.col(CORRUPT).isNotNull(), "rejected").when(late, "late").otherwise("good")


def _counts(log: DataFrame) -> DataFrame:
    event = F.col("outcome") != "rejected"
    return log.agg(
        F.count_if(event).alias("total_events"),
        F.count_if(event & F.col("is_late")).alias("late_events"),
        F.count_if(~event).alias("rejected_lines"),
    )


def ingest(
    events: DataFrame,
    output: str,
    tolerance_s: float = DELAY_S,
    drop_late: bool = False,
    arrival: Column | None = None,
    ts: str = "timestamp",
) -> StreamingQuery:
    """Write a parsed feed to ``output``: each event once, with its lateness decided once, whatever reads it later.

    ``log/batch=<n>/outcome=<good, late or rejected>`` holds the rows of micro-batch n, and ``batches/batch=<n>`` one row
    about it, counted from what was written. Both count once their marker is there. A micro-batch that is run again after a
    failure writes both anew. Without
    ``arrival`` an event arrives when its micro-batch begins. Handles what is there, then ends.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        begun = dt.datetime.now(dt.timezone.utc)
        now = F.lit(begun) if arrival is None else arrival
        rows = batch.withColumn("is_late", is_late(ts, now, tolerance_s)).withColumn("outcome", accepted(drop_late))
        path = f"{output}/log/batch={batch_id}"
        for table in ("log", BATCHES):
            withdraw(batch.sparkSession, output, table, batch_id)
        rows.write.mode("overwrite").partitionBy("outcome").parquet(path)
        spark = batch.sparkSession
        written = spark.read.schema(rows.schema).parquet(path)
        done = _counts(written)
        seconds = (dt.datetime.now(dt.timezone.utc) - begun).total_seconds()
        done = done.withColumns({"started": F.lit(begun), "latency_ms": F.lit(1000 * seconds), "batch": F.lit(batch_id).cast("long")})
        done.write.mode("overwrite").parquet(f"{output}/{BATCHES}/batch={batch_id}")
        for table in ("log", BATCHES):
            commit(spark, output, table, batch_id)

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{output}/progress/ingest")
        .trigger(availableNow=True)
        .start()
    )


def logged_schema(schema: T.StructType) -> T.StructType:
    """Of the rows that ``ingest`` writes for a feed of ``schema``."""
    return T.StructType([
        *schema.fields,
        T.StructField(CORRUPT, T.StringType()),
        T.StructField("is_late", T.BooleanType()),
        T.StructField("batch", T.LongType()),
        T.StructField("outcome", T.StringType()),
    ])


def tumbling_stream(events: DataFrame, size_s: int = 10, delay_s: float = DELAY_S, **columns: str) -> DataFrame:
    """Totals per window and category; a window is final once the watermark has passed its end."""
    ts = columns.get("ts", "timestamp")
    return tumbling_totals(watermarked(events, ts, delay_s), size_s=size_s, **columns)


def sliding_stream(
    events: DataFrame, size_s: int = 30, slide_s: int = 10, delay_s: float = DELAY_S, **columns: str
) -> DataFrame:
    """Mean amount per sliding window and region."""
    ts = columns.get("ts", "timestamp")
    return sliding_average(watermarked(events, ts, delay_s), size_s=size_s, slide_s=slide_s, **columns)


def open_windows(spark: SparkSession, progress: str, key: str = "category") -> DataFrame:
    """The windows that a query of ``tumbling_stream`` holds in its state, as its checkpoint has them: those not yet written."""
    held = spark.read.format("statestore").load(progress).where(F.col("key").isNotNull())
    window, named = held.schema["key"].dataType.names  # Spark's own names
    count, total = held.schema["value"].dataType.names
    return held.select(
        F.col("key").getField(window).getField("start").alias("window_start"),
        F.col("key").getField(window).getField("end").alias("window_end"),
        F.col("key").getField(named).alias(key),
        F.col("value").getField(count).alias("tx_count"),
        F.col("value").getField(total).alias("total_amount"),
    )


def deduplicated_stream(
    events: DataFrame, event_id: str = "event_id", ts: str = "timestamp", delay_s: float = DELAY_S
) -> DataFrame:
    """First arrival of each event id; ids are forgotten once the watermark is ``delay_s`` past them. Events without an
    id, which parsing rejects, would count as copies of each other here.

    Copies are first told apart by the task that read them. So an event that was sent very many times is dealt
    with in as many places as there are such tasks, and each passes on one copy at most.
    """
    read = watermarked(events.withColumn("_task", F.spark_partition_id()), ts, delay_s)
    once_per_task = read.dropDuplicatesWithinWatermark([event_id, "_task"])
    return once_per_task.dropDuplicatesWithinWatermark([event_id]).drop("_task")


def start(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream to a directory of files, each micro-batch exactly once.

    Without ``every`` the query handles what is there and ends; with it, it looks for new files at that
    interval until stopped. Started again with the same checkpoint it goes on where it ended.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def drain(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Handle what is there, then return the ended query, whose progress can still be read."""
    query = start(stream, path, checkpoint, fmt)
    query.awaitTermination()
    return query
