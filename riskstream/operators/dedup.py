"""Topics deliver at least once; this keeps one copy of each transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_copies(transactions: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The earliest copy per key in batch, ties broken by the whole row.

    A minimum over the row reduces map side, so many copies of one key shrink
    to one per task before the shuffle. Rows without a key can't be told to be
    copies: all pass, and are not shuffled.
    """
    rest = [c for c in transactions.columns if c != key and c not in order]
    keyed = transactions.where(F.col(key).isNotNull())
    copies = keyed.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("copy"))
    first = copies.select(key, "copy.*").select(transactions.columns)
    return first.union(transactions.where(F.col(key).isNull()))


def stream_copies(transactions: DataFrame, key: str) -> DataFrame:
    """One copy per key in a stream, for copies within its watermark's delay.

    A row without a key stands for itself under a name of its own.
    """
    named = transactions.withColumn(
        "copy_of",
        F.when(F.col(key).isNull(), F.concat(F.lit("none "), F.uuid())).otherwise(
            F.concat(F.lit("key "), F.col(key).cast("string"))
        ),
    )
    return named.dropDuplicatesWithinWatermark(["copy_of"]).drop("copy_of")
