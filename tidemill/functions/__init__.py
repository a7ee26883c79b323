"""Column expressions, all evaluated by Spark's built-in functions."""

from tidemill.functions.numeric import discounted, indicator, or_one, ratio, rounded_mean, shed_and_round, standardised
from tidemill.functions.temporal import cyclic, iso_text, micros, parse_iso, seconds_between

__all__ = [
    "cyclic",
    "discounted",
    "indicator",
    "iso_text",
    "micros",
    "or_one",
    "parse_iso",
    "ratio",
    "rounded_mean",
    "shed_and_round",
    "seconds_between",
    "standardised",
]
