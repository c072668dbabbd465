import math

import pytest
from pyspark.sql import functions as F

from riskstream.config import Policy
from riskstream.functions import decision
from riskstream.functions.features import half_up, micros
from riskstream.operators import scoring


def decided(spark, rows, policy=Policy()):
    frame = spark.createDataFrame(
        rows, "amount double, tx_hour int, location string, fraud_probability double"
    )
    return scoring.decide(frame, policy).collect()


@pytest.mark.parametrize(
    "amount, hour, location, expected",
    [
        (5000.0, 5, "Tunis", 0.0),
        (5000.000001, 5, "Tunis", 0.5),
        (4999.0, 4, "Tunis", 0.3),
        (1.0, 23, "FOREIGN_REMOTE", 0.2),
        (1.0, 23, None, 0.0),
        (9000.0, 0, "FOREIGN_REMOTE", 0.5 + 0.3 + 0.2),
        (9000.0, 0, "Sfax", 0.5 + 0.3),
        (None, None, None, 0.0),
    ],
)
def test_rule_points(spark, amount, hour, location, expected):
    (row,) = decided(spark, [(amount, hour, location, 0.0)])
    assert row.rule_score == expected


def reference_outcome(p, rules, w=0.6):
    final = p * w + rules * (1.0 - w)
    level = int(final * 10)
    cls = "FRAUD" if final > 0.7 else "SUSPICIOUS" if final > 0.4 else "NORMAL"
    why = (
        "High ML Alert + Risky Rules"
        if final > 0.7
        else "Extreme ML Anomaly"
        if p > 0.8
        else "High Rule Trigger"
        if rules > 0.8
        else "Normal activity"
    )
    return final, level, cls, why


def test_blend_on_a_grid(spark):
    inputs = [(9000.0, 0, "FOREIGN_REMOTE"), (9000.0, 0, "Sfax"), (1.0, 0, "Sfax"), (1.0, 9, "Sfax")]
    grid = [(*i, k / 200) for i in inputs for k in range(201)]
    for row in decided(spark, grid):
        found = (row.final_fraud_score, row.risk_level, row.prediction, row.reason)
        assert found == reference_outcome(row.fraud_probability, row.rule_score)


def test_rare_outcomes(spark):
    # All rules at probability 0 score exactly 0.4, which is not above 0.4.
    (row,) = decided(spark, [(9000.0, 0, "FOREIGN_REMOTE", 0.0)])
    assert (row.prediction, row.reason) == ("NORMAL", "High Rule Trigger")
    # Two rules at 0.8 are not above 0.8.
    (row,) = decided(spark, [(9000.0, 0, "Sfax", 0.0)])
    assert row.reason == "Normal activity"
    # Neither side reaches FRAUD alone.
    (row,) = decided(spark, [(1.0, 9, "Sfax", 1.0)])
    assert row.prediction == "SUSPICIOUS" and row.reason == "Extreme ML Anomaly"


def test_weight_is_one_double_subtraction(spark):
    policy = Policy(ml_weight=0.7)
    (row,) = decided(spark, [(9000.0, 0, "FOREIGN_REMOTE", 0.0)], policy)
    assert row.final_fraud_score == 1.0 * (1.0 - 0.7) == 0.30000000000000004


def test_threshold_setting_is_honoured(spark):
    (row,) = decided(spark, [(9000.0, 0, "FOREIGN_REMOTE", 0.2)], Policy(fraud_threshold=0.5))
    assert row.prediction == "FRAUD"


def test_candidates_never_lose_a_fraud(spark):
    inputs = [
        (a, h, loc, p / 1000)
        for a in (1.0, 9000.0)
        for h in (0, 9)
        for loc in ("Tunis", "FOREIGN_REMOTE")
        for p in range(0, 1001, 5)
    ]
    frame = spark.createDataFrame(
        inputs, "amount double, tx_hour int, location string, fraud_probability double"
    )
    for policy in (Policy(), Policy(ml_weight=0.9), Policy(ml_weight=0.1), Policy(fraud_threshold=0.6)):
        allowed = decision.may_be_fraud(F.col("amount"), F.col("tx_hour"), F.col("location"), policy)
        lost = scoring.decide(frame, policy).where((F.col("prediction") == "FRAUD") & ~allowed)
        assert lost.isEmpty()


def test_policy_is_checked():
    with pytest.raises(ValueError):
        Policy(ml_weight=1.5)
    with pytest.raises(ValueError):
        Policy(fraud_threshold=0.3)


def test_rounding_helpers(spark):
    row = spark.range(1).select(
        half_up(F.lit(0.125), 2).alias("a"),
        half_up(F.lit(0.285), 2).alias("b"),
        micros(F.lit(4938.0000009)).alias("m"),
    ).first()
    assert (row.a, row.b, row.m) == (0.13, math.floor(0.285 * 100 + 0.5) / 100, 4938000001)
