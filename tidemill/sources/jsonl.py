"""Event feeds: directories to which files of one JSON object per line are added."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import iso_text
from tidemill.operators.quality import CORRUPT
from tidemill.sources.transactions import EVENT

FEED_FILES = "batch_*.jsonl"


# What an event cannot be without.
REQUIRED = ("event_id", "timestamp", "category", "amount")

#: Amounts from here on are taken for errors. Sums of smaller ones stay exact for 10^14 events.
LARGEST = 1e15

_EVENT, _END = "_event_of_line", "_end_of_line"


def is_blank(line: str = "value") -> Column:
    """Whether a line has nothing but white space."""
    return ~F.col(line).rlike(r"\S")


def parse_lines(
    lines: DataFrame,
    schema: T.StructType = EVENT,
    required: Sequence[str] = REQUIRED,
    largest: float = LARGEST,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Events from lines of JSON. Each line that is not blank gives one row: an event, or a reject, which has the whole
    line in ``_corrupt_record``. ``keep`` names other columns of the lines that stay.

    Rejected are lines that are not one JSON object, with nothing after it, of values that fit the schema, those that
    lack one of the ``required`` fields, and those with a floating-point number that is none, infinite, or ``largest`` or
    more from zero: it would spoil every sum it is part of. Spark's parser ends at the first complete value, so the line is made a field
    of an object with another one behind it: what follows the event in its line then breaks the whole.
    """
    whole = T.StructType([
        T.StructField(_EVENT, schema),
        T.StructField(_END, T.IntegerType()),
        T.StructField(CORRUPT, T.StringType()),
    ])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    wrapped = F.concat(F.lit(f'{{"{_EVENT}":'), F.col("value"), F.lit(f',"{_END}":1}}'))
    parsed = lines.where(~is_blank()).select("value", *keep, F.from_json(wrapped, whole, options).alias("_line"))
    event = F.col("_line").getField(_EVENT)
    present = [event.getField(c).isNotNull() for c in required if c in schema.names]
    numbers = [event.getField(f.name) for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    present += [F.coalesce(F.abs(n) < F.lit(largest), n.isNull()) for n in numbers]  # NaN is larger than any number
    sound = reduce(and_, present, F.col("_line").getField(CORRUPT).isNull() & (F.col("_line").getField(_END) == 1) & event.isNotNull())
    sound = F.coalesce(sound, F.lit(False))
    return parsed.select(
        *[F.when(sound, event.getField(c)).alias(c) for c in schema.names],
        F.when(~sound, F.col("value")).alias(CORRUPT),
        *keep,
    )


def read_feed(spark: SparkSession, path: str, schema: T.StructType = EVENT, files: str = FEED_FILES) -> DataFrame:
    """All events of a feed as a table."""
    return parse_lines(spark.read.option("pathGlobFilter", files).text(path), schema)


def stream_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType = EVENT,
    files: str = FEED_FILES,
    max_files: int | None = None,
) -> DataFrame:
    """The feed as a stream, oldest file first; ``max_files`` limits how many make up one micro-batch."""
    reader = spark.readStream.option("pathGlobFilter", files)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_lines(reader.text(path), schema)


def feed_lines(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One line of JSON per row, with the timestamp as ISO-8601 text. NULL fields are left out."""
    shown = df.withColumn(ts, iso_text(F.col(ts)))
    return shown.select(F.to_json(F.struct(*shown.columns)).alias("value"))
