"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the five-decimal pi that published cyclical features are computed with.
PI = 3.14159

_ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def cyclic(position: Column, period: int, pi: float = PI) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle of ``period`` steps."""
    angle = position * F.lit(2 * pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for timestamps with and without zone."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds as double, negative if ``end`` is earlier."""
    return (micros(end) - micros(start)) / F.lit(1_000_000.0)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text in UTC; the fraction is left out when it is zero. A timestamp without zone is taken as UTC."""
    ts = F.when(F.typeof(ts) == "timestamp_ntz", ts.cast("timestamp_ntz")).otherwise(
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))
    )
    fraction = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, _ISO_SECONDS),
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
        F.lit("+00:00"),
    )


def parse_iso(text: Column) -> Column:
    """Instant named by ISO-8601 text, NULL if the text is malformed."""
    return F.try_to_timestamp(text)
