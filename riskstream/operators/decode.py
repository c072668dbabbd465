"""Messages to typed transactions, with unusable ones set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream import schema
from riskstream.functions.features import event_time, is_finite

CORRUPT = "_corrupt_record"

# Why a message cannot be scored, in the order the checks run.
CAUSE_EMPTY = "empty payload"
CAUSE_MALFORMED = "malformed json"
CAUSE_NO_AMOUNT = "missing amount"
CAUSE_BAD_AMOUNT = "amount not finite"
CAUSE_NO_CHANNEL = "missing is_online"
CAUSE_BAD_TIME = "unreadable timestamp"


def _json_struct(payload: Column, fields: T.StructType) -> Column:
    with_corrupt = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(
        payload, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )


def _unreadable(record: Column, payload: Column) -> Column:
    """A cause for payloads that are no JSON object of the declared types."""
    return F.when(record.isNull() | (F.trim(payload) == ""), CAUSE_EMPTY).when(
        record[CORRUPT].isNotNull(), CAUSE_MALFORMED
    )


def _inspected(parsed: DataFrame, fields: list[str], cause: Column) -> DataFrame:
    """The decoded fields, the ``cause`` and, on barred rows only, the payload.

    Exploding a one-element array keeps filters on the result above the parse;
    pushed below it, they would parse each payload again.
    """
    checked = F.struct(
        *[F.col("record")[name].alias(name) for name in fields],
        F.when(cause.isNotNull(), F.col("payload")).alias("value"),
        cause.alias("cause"),
    )
    return parsed.select(F.explode(F.array(checked)).alias("checked")).select("checked.*")


def _parsed(messages: DataFrame, fields: T.StructType) -> DataFrame:
    payload = F.col("value").cast("string")
    return messages.select(payload.alias("payload"), _json_struct(payload, fields).alias("record"))


def inspect_transactions(messages: DataFrame) -> DataFrame:
    """Decode ``value`` and name the ``cause`` that bars a row from scoring."""
    record = F.col("record")
    cause = (
        _unreadable(record, F.col("payload"))
        .when(record["amount"].isNull(), CAUSE_NO_AMOUNT)
        .when(~is_finite(record["amount"]), CAUSE_BAD_AMOUNT)
        .when(record["is_online"].isNull(), CAUSE_NO_CHANNEL)
        .when(event_time(record["timestamp"]).isNull(), CAUSE_BAD_TIME)
    )
    parsed = _parsed(messages, schema.TRANSACTION)
    return _inspected(parsed, schema.TRANSACTION_FIELDS, cause)


def usable(inspected: DataFrame) -> DataFrame:
    return inspected.where(F.col("cause").isNull()).select(schema.TRANSACTION_FIELDS)


def dead_letters(inspected: DataFrame) -> DataFrame:
    return inspected.where(F.col("cause").isNotNull()).select("value", "cause")


def decode_transactions(messages: DataFrame) -> DataFrame:
    return usable(inspect_transactions(messages))


def quarantine(messages: DataFrame) -> DataFrame:
    return dead_letters(inspect_transactions(messages))


def inspect_alerts(messages: DataFrame) -> DataFrame:
    """Decode alert payloads; one without a probability cannot be shown."""
    record = F.col("record")
    cause = _unreadable(record, F.col("payload")).when(
        record["fraud_probability"].isNull(), "missing fraud_probability"
    )
    return _inspected(_parsed(messages, schema.ALERT), schema.ALERT_FIELDS, cause)
