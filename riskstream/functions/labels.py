"""Training labels and the holdout split as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskstream.functions.decision import LARGE_AMOUNT, REMOTE_LOCATION, points

# What each condition adds to the training score, and its cut.
TRAIN_AMOUNT_POINTS = 0.4
TRAIN_NIGHT_POINTS = 0.2
TRAIN_REMOTE_POINTS = 0.4
NOISE_SCALE = 0.2
MORNING_STARTS = 6
EVENING_ENDS = 22
TRAIN_CUT = 0.6
RELABEL_LEVEL = 7

# Fixed values of the multiplicative hash behind the split.
SPLIT_PRIME = 2654435761
SPLIT_DOMAIN = 2**31
SPLIT_RANGE = 2**32


def training_score(amount: Column, hour: Column, location: Column, noise: Column) -> Column:
    """``noise`` is uniform in [0, 1)."""
    off_hours = (hour < MORNING_STARTS) | (hour > EVENING_ENDS)
    known = (
        points(amount > LARGE_AMOUNT, TRAIN_AMOUNT_POINTS)
        + points(off_hours, TRAIN_NIGHT_POINTS)
        + points(location == REMOTE_LOCATION, TRAIN_REMOTE_POINTS)
    )
    return known + noise * F.lit(NOISE_SCALE)


def training_label(score: Column) -> Column:
    return F.when(score > TRAIN_CUT, 1).otherwise(0)


def relabel(risk_level: Column) -> Column:
    """Label for rows that were already scored once."""
    return F.when(risk_level >= RELABEL_LEVEL, 1).otherwise(0)


def split_bucket(key: Column) -> Column:
    """0..99 from an integer key: the same row always lands on the same side."""
    mixed = F.pmod(key, F.lit(SPLIT_DOMAIN)) * F.lit(SPLIT_PRIME) % F.lit(SPLIT_RANGE)
    return F.floor(mixed / F.lit(65536.0)).cast("bigint") % F.lit(100)
