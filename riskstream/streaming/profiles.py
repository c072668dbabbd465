"""Users' profiles kept up to date: each batch adds its sums, readers merge them.

A batch is reduced, map side, to a count and an exact sum by user and pane of time. Sums of
millionths add up in any order, so batches may come late, out of order or again, and a
profile equals ``velocity.tumbling`` over all transactions at any time. It reads a row for
each user, pane and batch, not the transactions; compaction leaves one for each user and
pane.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.functions.features import from_micros, half_up, micros, unsummable
from riskstream.operators.velocity import HOUR, SECOND
from riskstream.streaming.committed import CommittedTable
from riskstream.streaming.sinks import BatchRef

SUMS = "user_id string, pane bigint, n bigint, worth decimal(38,0), odd bigint"


def _merged(sums: DataFrame) -> DataFrame:
    return sums.groupBy("user_id", "pane").agg(
        F.sum("n").alias("n"), F.sum("worth").cast("decimal(38,0)").alias("worth"),
        F.sum("odd").alias("odd"),
    )


class Profiles:
    """Sums by user and pane of ``pane`` seconds under ``root``, which executors share."""

    def __init__(self, spark: SparkSession, root: str, pane: float = HOUR) -> None:
        self.table = CommittedTable(spark, root, SUMS)
        self.pane = round(pane * SECOND)

    def add(self, transactions: DataFrame, batch: BatchRef) -> None:
        """The sums of a batch with ``user_id``, ``ts`` and ``amount``; a replay replaces them.

        Rows without a time are in no pane.
        """
        at, amount = F.unix_micros("ts"), F.col("amount")
        start = at - F.pmod(at, F.lit(self.pane))
        sums = transactions.where(F.col("ts").isNotNull()).groupBy(
            F.col("user_id").cast("string").alias("user_id"), start.alias("pane")
        ).agg(
            F.count(F.lit(1)).alias("n"),
            # Null where no amount is known, as in a sum over the transactions.
            F.sum(micros(amount)).cast("decimal(38,0)").alias("worth"),
            F.count(F.when(unsummable(amount), 1)).alias("odd"),
        )
        self.table.write(sums, batch)

    def read(self, seconds: float = 6 * HOUR) -> DataFrame:
        """Count and sum per user and window, whose length is a multiple of the pane's."""
        length = round(seconds * SECOND)
        if length % self.pane:
            raise ValueError(f"{seconds} seconds are no multiple of a pane")
        window = F.col("pane") - F.pmod("pane", F.lit(length))
        whole = _merged(self.table.read().withColumn("pane", window))
        total = half_up(from_micros(F.col("worth")), 2)
        return whole.select(
            F.timestamp_micros("pane").alias("window_start"), "user_id", "n",
            F.when(F.col("odd") == 0, total).alias("total"),
        )

    def compact(self, files: int | None = None) -> int:
        return self.table.compact(files, _merged)
