"""Feature expressions: types, event time and the checks that guard scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(text: Column) -> Column:
    """ISO text to TIMESTAMP; null, not an error, when it cannot be read."""
    return text.try_cast("timestamp")


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def micros(value: Column) -> Column:
    """A money amount in whole millionths, so that sums are exact in any order.

    Null when the amount isn't finite or has more than 28 digits in millionths: 10^10
    of the largest still add up without overflow.
    """
    return F.rint(value * F.lit(1e6)).try_cast("decimal(28,0)")


def unsummable(value: Column) -> Column:
    """Whether an amount is there but has no exact millionths."""
    return value.isNotNull() & micros(value).isNull()


def from_micros(total: Column) -> Column:
    return total.cast("double") / F.lit(1e6)


def half_up(value: Column, digits: int) -> Column:
    """Round by one multiply, floor and divide: the same double on any engine.

    From 2^53 on a scaled double has no fraction, and stays as it is.
    """
    scale = F.lit(float(10**digits))
    scaled = value * scale + F.lit(0.5)
    small = F.abs(scaled) < F.lit(float(2**53))
    return F.when(small, F.floor(F.when(small, scaled)).cast("double") / scale).otherwise(value)
