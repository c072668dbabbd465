"""The decision step as column expressions over one row."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskstream.config import Policy

# Rule limits, points, class names and reasons.
LARGE_AMOUNT = 5000
NIGHT_ENDS = 5
REMOTE_LOCATION = "FOREIGN_REMOTE"
LARGE_AMOUNT_POINTS = 0.5
NIGHT_POINTS = 0.3
REMOTE_POINTS = 0.2
ANOMALY_PROBABILITY = 0.8
RULE_TRIGGER = 0.8
FRAUD = "FRAUD"
SUSPICIOUS = "SUSPICIOUS"
NORMAL = "NORMAL"
REASON_BLEND = "High ML Alert + Risky Rules"
REASON_MODEL = "Extreme ML Anomaly"
REASON_RULES = "High Rule Trigger"
REASON_NONE = "Normal activity"


def points(condition: Column, worth: float) -> Column:
    return F.when(condition, F.lit(worth)).otherwise(F.lit(0.0))


def rule_score(amount: Column, hour: Column, location: Column) -> Column:
    # Summed left to right: doubles do not associate.
    return reduce(
        add,
        [
            points(amount > LARGE_AMOUNT, LARGE_AMOUNT_POINTS),
            points(hour < NIGHT_ENDS, NIGHT_POINTS),
            points(location == REMOTE_LOCATION, REMOTE_POINTS),
        ],
    )


def final_score(probability: Column, rules: Column, policy: Policy) -> Column:
    return probability * F.lit(policy.ml_weight) + rules * F.lit(policy.rule_weight)


def risk_level(final: Column) -> Column:
    """Tenths of the final score, truncated."""
    return (final * 10).cast("int")


def risk_class(final: Column, policy: Policy) -> Column:
    return (
        F.when(final > policy.fraud_threshold, FRAUD)
        .when(final > policy.suspicious_threshold, SUSPICIOUS)
        .otherwise(NORMAL)
    )


def reason(final: Column, probability: Column, rules: Column, policy: Policy) -> Column:
    """The first reason that applies."""
    return (
        F.when(final > policy.fraud_threshold, REASON_BLEND)
        .when(probability > ANOMALY_PROBABILITY, REASON_MODEL)
        .when(rules > RULE_TRIGGER, REASON_RULES)
        .otherwise(REASON_NONE)
    )


def may_be_fraud(amount: Column, hour: Column, location: Column, policy: Policy) -> Column:
    """False only where no probability could reach the fraud threshold.

    The blend grows with the probability, and doubles round monotonically, so
    the score at probability 1 bounds the score at any other. It needs only raw
    columns: an alert-only job can drop rows before it runs the forest.
    """
    return final_score(F.lit(1.0), rule_score(amount, hour, location), policy) > (
        policy.fraud_threshold
    )
