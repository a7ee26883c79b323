"""Numeric and flag expressions, safe under ANSI mode."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def discounted(amount: Column, fraction: Column) -> Column:
    """Amount left after taking off ``fraction`` (0..1) of it."""
    return amount * (F.lit(1) - fraction)


def indicator(column: Column, value: object) -> Column:
    """1 where the column equals ``value``, 0 where it does not, NULL where it is NULL."""
    return (column == F.lit(value)).cast("int")


def or_one(spread: Column) -> Column:
    """A divisor that is never zero: NULL and 0 become 1."""
    return F.coalesce(F.nullif(spread, F.lit(0.0)), F.lit(1.0))


def standardised(column: Column, mean: Column, spread: Column) -> Column:
    """Distance from the mean in units of the spread."""
    return ((column - mean) / or_one(spread)).cast("double")


def rounded_mean(total: Column, count: Column, digits: int) -> Column:
    """Exact mean of a decimal sum, rounded once, half away from zero; NULL where there is nothing to average, or where
    the sum is too large for that many digits."""
    twice = F.try_add(F.try_multiply(F.abs(total), F.lit(Decimal(2 * 10**digits))), count)
    steps = F.call_function("div", twice, F.nullif(2 * count, F.lit(0)).cast("decimal(20, 0)"))
    return F.signum(total) * steps / F.lit(10.0**digits)


def shed_and_round(column: Column, digits: int) -> Column:
    """Round half away from zero, taking for a half what lies within 1/200,000 of a last digit below it.

    For comparing engines only: the last bits of a floating-point value depend on the order of additions and on the
    engine. Values that are published are rounded exactly, see ``rounded_mean``.
    """
    scale = F.lit(10.0**digits)
    return F.rint(column * scale + F.signum(column) * F.lit(0.000005)) / scale
