"""Schemas of the transaction record, and batch reading and writing of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The categories, regions and devices of a transaction.
CATEGORIES = ("electronics", "clothing", "food", "sports", "books", "home")
REGIONS = ("north", "south", "east", "west", "central")
DEVICES = ("mobile", "desktop", "tablet")

_MEASURES = [
    T.StructField("amount", T.DoubleType()),
    T.StructField("category", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("session_duration", T.LongType()),
    T.StructField("items_in_cart", T.LongType()),
    T.StructField("is_returned", T.LongType()),
    T.StructField("discount_pct", T.DoubleType()),
    T.StructField("page_views", T.LongType()),
]

TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        *_MEASURES,
    ]
)

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        *_MEASURES,
    ]
)


def read_transactions(
    spark: SparkSession, path: str, partitions: int | None = None, by: str | None = None, schema: T.StructType = TRANSACTION
) -> DataFrame:
    """Parquet files of a directory as one table.

    ``partitions`` redistributes the rows, round robin or by a column. It shuffles the whole table and is
    seldom worth it: Spark already splits and packs files by ``spark.sql.files.maxPartitionBytes``.
    """
    df = spark.read.schema(schema).parquet(path)
    if partitions is None:
        return df
    return df.repartition(partitions, by) if by else df.repartition(partitions)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, by: str = "user_id", buckets: int = 200, path: str | None = None) -> None:
    """The rows as a table of the session's catalog, dealt into ``buckets`` by a hash of a column and sorted by it there.

    Aggregates by that column, and joins on it with tables that have as many buckets, then need no shuffle: the one made
    here serves all later runs. Rows are first gathered by bucket, so that each has one file.
    """
    writer = df.repartition(buckets, by).write.mode("overwrite").bucketBy(buckets, by).sortBy(by)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_dated(df: DataFrame, path: str, ts: str = "timestamp", date: str = "event_date") -> None:
    """Parquet with one directory per day, so that a date filter reads only its days.

    The rebalance hint gathers each day in few files, and lets adaptive execution cut a day that is too
    large for one task into several.
    """
    dated = df.withColumn(date, F.to_date(ts))
    dated.hint("rebalance", date).write.mode("overwrite").partitionBy(date).parquet(path)


def read_dated(spark: SparkSession, path: str, first: str, last: str, date: str = "event_date") -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included; other days are not read."""
    return spark.read.parquet(path).where(F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
