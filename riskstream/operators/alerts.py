"""What leaves the engine: messages, alerts, summaries and their text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream import schema
from riskstream.functions.decision import FRAUD, SUSPICIOUS
from riskstream.functions.features import half_up

# The columns of a preview.
PREVIEW_FIELDS = [
    "transaction_id",
    "user_id",
    "amount",
    "fraud_probability",
    "final_fraud_score",
    "prediction",
]


def _messages(frame: DataFrame, key: str, fields: list[str]) -> DataFrame:
    return frame.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )


def transaction_messages(transactions: DataFrame) -> DataFrame:
    """Raw transactions for the inbound topic, keyed by user to keep their order."""
    return _messages(transactions, "user_id", schema.TRANSACTION_FIELDS)


def by_user_and_time(rows: DataFrame, time: str) -> DataFrame:
    """Rows dealt in ranges of user and time, ascending within each partition.

    A user's rows are published in order by each task. A busy user fills several
    ranges, one time after the other, so no task holds more than its share.
    """
    order = ["user_id", time, "transaction_id"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def scored_messages(scored: DataFrame) -> DataFrame:
    return _messages(scored, "user_id", schema.SCORED_FIELDS)


def fraud_only(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("prediction") == FRAUD)


def alert_messages(scored: DataFrame) -> DataFrame:
    return _messages(fraud_only(scored), "transaction_id", schema.ALERT_FIELDS)


def summary_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("prediction") == FRAUD).alias("alerts"),
        F.count_if(F.col("prediction") == SUSPICIOUS).alias("suspicious"),
        F.count_if(F.col("user_id").isNull()).alias("unkeyed"),
    ]


def batch_summary(scored: DataFrame) -> DataFrame:
    """One row of counts, in one pass."""
    return scored.agg(*summary_columns())


def preview(scored: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` riskiest rows, in a total order."""
    return (
        scored.select(PREVIEW_FIELDS)
        .orderBy(F.desc("final_fraud_score"), "transaction_id")
        .limit(n)
    )


def _shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def with_alert_text(alerts: DataFrame) -> DataFrame:
    """The text an analyst reads, and its one-line warning."""
    ident, user, level, why = (
        _shown(F.col(c)) for c in ("transaction_id", "user_id", "risk_level", "reason")
    )
    chance = F.format_string("%.2f", half_up(F.col("fraud_probability"), 2))
    # The wording and alignment of an alert.
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Transaction ID: "), ident),
        F.concat(F.lit("User ID:        "), user),
        F.concat(F.lit("Risk Level:     "), level, F.lit("/10")),
        F.concat(F.lit("Probability:    "), chance),
        F.concat(F.lit("Reason:         "), why),
    )
    warning = F.concat(
        F.lit("Fraud alert for user "), user, F.lit(" - Score: "), level
    )
    return alerts.withColumns({"alert_text": text, "warning": warning})
