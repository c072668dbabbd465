"""Transactions derived from the ``events`` table, one per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.functions.decision import REMOTE_LOCATION
from riskstream.session import pin_zone

# Which place, method and category an event stands for.
_CITIES = ("Tunis", "Sousse", "Sfax", "Monastir", "Tunis", "Sousse", "Sfax", REMOTE_LOCATION)
_METHODS = ("CARD", "MOBILE_PAYMENT", "BANK_TRANSFER", "CASH")
_CATEGORIES = {
    "click": "GROCERY",
    "view": "FASHION",
    "signup": "ELECTRONICS",
    "purchase": "RESTAURANT",
    "error": "TRAVEL",
}


# The columns in use; naming them spares a job that would read file footers.
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
)


def _pick(index, values):
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def as_transactions(events: DataFrame) -> DataFrame:
    """Transaction fields plus ``event_id`` and the event time ``ts``."""
    event, user = F.col("event_id"), F.col("user_id")
    category = F.create_map(*[F.lit(x) for pair in _CATEGORIES.items() for x in pair])
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        event.cast("string").alias("transaction_id"),
        F.concat(F.lit("USER_"), (user + 1000).cast("string")).alias("user_id"),
        ts.alias("ts"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        (F.col("value") * F.lit(40.0)).alias("amount"),
        F.lit("TND").alias("currency"),
        _pick(event % 8, _CITIES).alias("location"),
        _pick(event % 4, _METHODS).alias("payment_method"),
        category[F.col("event_type")].alias("merchant_category"),
        (event % 2 == 0).alias("is_online"),
        F.concat(F.lit("DEV_"), (user % 900 + 100).cast("string")).alias("device_id"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    table = f"{folder}/events.parquet"
    return as_transactions(pin_zone(spark).read.schema(EVENTS).parquet(table))


def stand_in_probability() -> Column:
    """A probability in exact thousandths, for checking the rules alone."""
    return (F.col("event_id") * 7919 % 1001).cast("double") / F.lit(1000.0)
