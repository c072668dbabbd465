"""Whole chains over messages and transactions, in batch."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from riskstream import schema
from riskstream.config import Policy
from riskstream.operators.alerts import fraud_only
from riskstream.operators.decode import decode_transactions
from riskstream.operators.scoring import (
    decide,
    fraud_candidates,
    score,
    with_features,
    with_probability,
)


def scored(
    messages: DataFrame, model: PipelineModel, policy: Policy = Policy()
) -> DataFrame:
    """Messages to scored rows: decode, features, forest, rules, blend, class."""
    return messages.transform(decode_transactions).transform(score, model, policy)


def frauds(
    messages: DataFrame, model: PipelineModel, policy: Policy = Policy()
) -> DataFrame:
    """Only the FRAUD rows: the forest sees no row whose rules rule it out."""
    return (
        messages.transform(decode_transactions)
        .transform(with_features)
        .transform(fraud_candidates, policy)
        .transform(with_probability, model)
        .transform(decide, policy)
        .transform(fraud_only)
        .select(schema.SCORED_FIELDS)
    )
