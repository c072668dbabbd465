"""Transactions to scored transactions: features, probability, decision."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream import schema
from riskstream.config import Policy
from riskstream.functions import decision
from riskstream.functions.features import event_time

# Columns the fitted pipeline adds for its own use.
MODEL_INTERNALS = [
    *[f"{name}_idx" for name in schema.CATEGORY_INPUTS],
    "features",
    "rawPrediction",
    "probability",
    "prediction",
]


def with_features(transactions: DataFrame) -> DataFrame:
    """Event time, its hour, and the channel flag as the model expects it."""
    when = event_time(F.col("timestamp"))
    return transactions.withColumns(
        {
            "is_online": F.col("is_online").cast("int"),
            "tx_timestamp": when,
            "tx_hour": F.hour(when),
        }
    )


def with_probability(featured: DataFrame, model: PipelineModel) -> DataFrame:
    """Fraud probability of the forest, without its internal columns.

    Exploding a one-element array keeps later filters, such as the one for
    alerts, above the forest; pushed below it, they would run the forest again.
    """
    once = F.explode(F.array(vector_to_array("probability")[1]))
    return (
        model.transform(featured).withColumn("fraud_probability", once).drop(*MODEL_INTERNALS)
    )


def with_rules(featured: DataFrame) -> DataFrame:
    return featured.withColumn(
        "rule_score",
        decision.rule_score(F.col("amount"), F.col("tx_hour"), F.col("location")),
    )


def with_final_score(ruled: DataFrame, policy: Policy = Policy()) -> DataFrame:
    return ruled.withColumn(
        "final_fraud_score",
        decision.final_score(F.col("fraud_probability"), F.col("rule_score"), policy),
    )


def with_decision(blended: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Risk level, class and reason from the blended score."""
    final, probability, rules = (
        F.col(c) for c in ("final_fraud_score", "fraud_probability", "rule_score")
    )
    return blended.withColumns(
        {
            "risk_level": decision.risk_level(final),
            "prediction": decision.risk_class(final, policy),
            "reason": decision.reason(final, probability, rules, policy),
        }
    )


def decide(with_p: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Everything after the probability."""
    return with_p.transform(with_rules).transform(with_final_score, policy).transform(
        with_decision, policy
    )


def score(
    transactions: DataFrame, model: PipelineModel, policy: Policy = Policy()
) -> DataFrame:
    """Usable transactions to scored rows; one stage, no shuffle."""
    return (
        transactions.transform(with_features)
        .transform(with_probability, model)
        .transform(decide, policy)
        .select(schema.SCORED_FIELDS)
    )


def fraud_candidates(featured: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Rows that could still be FRAUD, judged before the forest runs."""
    return featured.where(
        decision.may_be_fraud(F.col("amount"), F.col("tx_hour"), F.col("location"), policy)
    )
