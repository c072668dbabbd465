"""Seeded traffic and training rows, generated where the ids are.

Each generator takes a frame of integer ``id`` (``spark.range`` or any key
column) and adds no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.config import GeneratorConfig
from riskstream.functions import draws, labels
from riskstream.functions.decision import REMOTE_LOCATION

# What generated traffic looks like.
PAYMENT_METHODS = ("CARD", "MOBILE_PAYMENT", "BANK_TRANSFER", "CASH")
MERCHANT_CATEGORIES = (
    "GROCERY", "ELECTRONICS", "RESTAURANT", "TRAVEL", "FASHION", "PHARMACY",
)
CURRENCY = "TND"
USUAL_AMOUNT = (5.0, 500.0)
SUSPICIOUS_AMOUNT = (2000.0, 10000.0)
SUSPICIOUS_SHARE = 0.05
REMOTE_SHARE = 0.5
USER_IDS = (1000, 9999)
DEVICE_IDS = (100, 999)
BOT_IDS = (10, 99)
BURST_SIZE = (5, 12)
BURST_GAP = 0.1

# The narrower domain of synthetic training rows.
TRAINING_LOCATIONS = ("Tunis", "Sousse", "Sfax", REMOTE_LOCATION)
TRAINING_CATEGORIES = ("GROCERY", "ELECTRONICS", "TRAVEL")
TRAINING_AMOUNT = 10000.0


def training_rows(
    ids: DataFrame,
    seed: int = 42,
    locations: Sequence[str] = TRAINING_LOCATIONS,
    categories: Sequence[str] = TRAINING_CATEGORIES,
) -> DataFrame:
    """Labelled rows: raw model inputs, the noisy score and its label."""
    drawn = ids.select(
        "id",
        draws.digest(seed, "train-a", F.col("id")).alias("a"),
        draws.digest(seed, "train-b", F.col("id")).alias("b"),
    )
    a, b = F.col("a"), F.col("b")
    inputs = drawn.select(
        "id",
        (draws.uniform(a, 0) * F.lit(TRAINING_AMOUNT)).alias("amount"),
        draws.integer(draws.uniform(a, 1), 0, 23).alias("tx_hour"),
        (draws.uniform(a, 2) > 0.5).cast("int").alias("is_online"),
        draws.choice(draws.uniform(a, 3), locations).alias("location"),
        draws.choice(draws.uniform(b, 0), categories).alias("merchant_category"),
        draws.uniform(b, 1).alias("noise"),
    )
    score = labels.training_score(*(F.col(c) for c in ("amount", "tx_hour", "location", "noise")))
    return (
        inputs.withColumn("fraud_prob", score)
        .withColumn("label", labels.training_label(F.col("fraud_prob")))
        .drop("noise")
    )


def with_bursts(
    ids: DataFrame,
    seed: int = 42,
    probability: float = GeneratorConfig.burst_probability,
    sizes: tuple[int, int] = BURST_SIZE,
    locations: Sequence[str] = GeneratorConfig.locations,
) -> DataFrame:
    """One row per transaction to make: a lone one per id, or a burst.

    All rows of a burst share a user, a device and a city; lone rows have
    nulls there and draw their own.
    """
    drawn = ids.select("id", draws.digest(seed, "burst", F.col("id")).alias("a"))
    a = F.col("a")
    is_burst = draws.uniform(a, 0) < probability
    size = F.when(is_burst, draws.integer(draws.uniform(a, 1), *sizes)).otherwise(1)
    city_draw = draws.uniform(draws.digest(seed, "burst-city", F.col("id")), 0)
    return drawn.select(
        "id",
        F.explode(F.sequence(F.lit(0), size - 1)).alias("step"),
        F.when(
            is_burst,
            F.concat(F.lit("VOL_"), draws.integer(draws.uniform(a, 2), *USER_IDS)),
        ).alias("burst_user"),
        F.when(
            is_burst,
            F.concat(F.lit("DEV_BOT_"), draws.integer(draws.uniform(a, 3), *BOT_IDS)),
        ).alias("burst_device"),
        F.when(is_burst, draws.choice(city_draw, locations)).alias("burst_location"),
    )


def transactions(
    ids: DataFrame,
    seed: int = 42,
    config: GeneratorConfig = GeneratorConfig(),
    start: str = "2026-01-01T00:00:00",
    gap: float = BURST_GAP,
) -> DataFrame:
    """Transaction records, bursts included, ``config.interval`` apart by id."""
    plan = with_bursts(
        ids, seed, config.burst_probability, locations=config.locations
    )
    key = (F.col("id"), F.col("step"))
    drawn = plan.withColumns({s: draws.digest(seed, f"tx-{s}", *key) for s in ("a", "b", "ident")})
    a, b, ident = F.col("a"), F.col("b"), F.col("ident")

    suspicious = draws.uniform(a, 0) < SUSPICIOUS_SHARE
    amount = F.when(
        suspicious, draws.between(draws.uniform(a, 1), *SUSPICIOUS_AMOUNT, 3)
    ).otherwise(draws.between(draws.uniform(a, 1), *USUAL_AMOUNT, 3))
    city = F.coalesce("burst_location", draws.choice(draws.uniform(a, 2), config.locations))
    remote = suspicious & (draws.uniform(a, 3) < REMOTE_SHARE)
    user = F.concat(F.lit("USER_"), draws.integer(draws.uniform(b, 0), *USER_IDS))
    device = F.concat(F.lit("DEV_"), draws.integer(draws.uniform(b, 1), *DEVICE_IDS))
    offset = F.col("id") * F.lit(round(config.interval * 1e6)) + F.col("step") * F.lit(
        round(gap * 1e6)
    )
    at = F.timestamp_micros(F.unix_micros(F.lit(start).cast("timestamp")) + offset)
    return drawn.select(
        draws.uuid_text(ident).alias("transaction_id"),
        F.coalesce("burst_user", user).alias("user_id"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        amount.alias("amount"),
        F.lit(CURRENCY).alias("currency"),
        F.when(remote, REMOTE_LOCATION).otherwise(city).alias("location"),
        draws.choice(draws.uniform(b, 2), PAYMENT_METHODS).alias("payment_method"),
        draws.choice(draws.uniform(b, 3), MERCHANT_CATEGORIES).alias("merchant_category"),
        draws.coin(ident).alias("is_online"),
        F.coalesce("burst_device", device).alias("device_id"),
    )
