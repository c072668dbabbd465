"""Repeatable random draws: each depends on a row's id and nothing else.

The result is the same for any partitioning, on any retry of a lost task, and
can be recomputed by another engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int, stream: str, *ids: Column) -> Column:
    """32 hex digits; ``stream`` separates independent draws of one row."""
    return F.md5(F.concat_ws(":", F.lit(f"{seed}:{stream}"), *[i.cast("string") for i in ids]))


def uniform(hex_digits: Column, part: int) -> Column:
    """One of the four uniform doubles in [0, 1) that a digest holds."""
    word = F.substring(hex_digits, 8 * part + 1, 8)
    return F.conv(word, 16, 10).cast("double") / F.lit(float(2**32))


def between(u: Column, low: float, high: float, digits: int) -> Column:
    """Uniform amount, rounded half up to ``digits``."""
    scale = F.lit(float(10**digits))
    return F.floor((u * F.lit(high - low) + F.lit(low)) * scale + F.lit(0.5)) / scale


def integer(u: Column, low: int, high: int) -> Column:
    """Uniform integer with both ends included."""
    return (F.floor(u * F.lit(float(high - low + 1))) + F.lit(low)).cast("int")


def choice(u: Column, values: Sequence[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), integer(u, 1, len(values)))


def uuid_text(hex_digits: Column) -> Column:
    """A digest in the shape of a random UUID (version 4, first variant)."""
    part = lambda start, n: F.substring(hex_digits, start, n)
    return F.concat(
        part(1, 8), F.lit("-"), part(9, 4), F.lit("-4"), part(14, 3),
        F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12),
    )


def coin(hex_digits: Column) -> Column:
    """A fair coin from the digit that ``uuid_text`` replaces by the version."""
    return F.substring(hex_digits, 13, 1) < "8"
