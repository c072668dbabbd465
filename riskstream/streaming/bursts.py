"""Bursts of a user's transactions, beside the scores: an opt-in output of the scoring job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.functions.features import event_time
from riskstream.operators import velocity
from riskstream.operators.decode import decode_transactions
from riskstream.operators.dedup import stream_copies

# How late a message may come; a window is reported once it can't change any more.
DELAY = "1 hour"
AT_LEAST = 5


def burst_windows(
    messages: DataFrame,
    delay: str = DELAY,
    seconds: float = 6 * velocity.HOUR,
    slide: float = 2 * velocity.HOUR,
    at_least: int = AT_LEAST,
) -> DataFrame:
    """Users' windows of at least so many transactions; redelivered ones count once."""
    timed = decode_transactions(messages).withColumn("ts", event_time(F.col("timestamp")))
    once = stream_copies(timed.withWatermark("ts", delay), "transaction_id")
    return velocity.bursts(velocity.sliding(once, seconds, slide), at_least)


def start(
    messages: DataFrame, folder: str, checkpoint: str, name: str = "bursts",
    trigger: dict | None = None, **shape,
) -> StreamingQuery:
    """Append closed burst windows to ``folder``; the file sink keeps each batch once."""
    writer = (
        burst_windows(messages, **shape)
        .writeStream.queryName(name).outputMode("append").format("parquet")
        .option("path", folder).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
