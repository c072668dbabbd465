"""The alert feed: alert messages as text an analyst can read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream import schema
from riskstream.operators.alerts import with_alert_text
from riskstream.operators.decode import dead_letters, inspect_alerts
from riskstream.streaming.sinks import BatchRef, Sink


def read_alerts(messages: DataFrame) -> DataFrame:
    """Readable alerts with their text; batch or stream."""
    decoded = inspect_alerts(messages)
    return with_alert_text(decoded.where("cause IS NULL").select(schema.ALERT_FIELDS))


def rejected_alerts(messages: DataFrame) -> DataFrame:
    """Payloads no text could be made of; the feed goes on without them."""
    return dead_letters(inspect_alerts(messages))


def start(
    messages: DataFrame,
    feed: Sink,
    rejected: Sink,
    checkpoint: str,
    name: str = "alerts",
    trigger: dict | None = None,
) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        ref = BatchRef(run, batch_id)
        seen = Observation()
        inspected = inspect_alerts(batch)
        counted = inspected.observe(seen, F.count("cause").alias("rejected"))
        feed(with_alert_text(counted.where("cause IS NULL").select(schema.ALERT_FIELDS)), ref)
        # Payloads are read again only if some are unusable.
        letters = dead_letters(inspected)
        rejected(letters if seen.get["rejected"] else letters.limit(0), ref)

    writer = (
        messages.select("value")
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
