"""The scoring stream: messages in; table, topics, cases and dead letters out."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream import schema
from riskstream.config import Policy
from riskstream.functions.features import event_time
from riskstream.operators import alerts
from riskstream.operators.decode import dead_letters, inspect_transactions, usable
from riskstream.operators.scoring import score
from riskstream.streaming.committed import CommittedTable
from riskstream.streaming.profiles import Profiles
from riskstream.streaming.sinks import BatchRef, Delivery, Sink, files
from riskstream.streaming.stored import StoredIds

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outputs:
    """``table`` is the root of the stored scores; the others are optional.

    With ``ids`` a redelivered transaction is stored, sent and counted once. ``in_order``
    sorts what goes to the scored topic by user and time, at the cost of a shuffle. With
    ``committed`` readers of the table see whole batches (``CommittedTable``). ``profiles``
    are kept up to date from the stored rows. ``report`` is told of every batch, also of one
    that an output fails.
    """

    table: str
    scored_topic: Sink | None = None
    alerts_topic: Sink | None = None
    cases: Sink | None = None
    dead_letter: Sink | None = None
    show: int = 5
    ids: StoredIds | None = None
    in_order: bool = False
    committed: bool = False
    profiles: Profiles | None = None
    report: Callable[[Delivery], None] | None = None


def deliver(
    wanted: dict[str, tuple[Sink | None, DataFrame, int]],
    batch: BatchRef,
    scored: int,
    report: Callable[[Delivery], None] | None,
) -> None:
    """Hand each output its frame, whose rows were counted before; report also a failure."""
    delivered: dict[str, int] = {}
    failed = None
    try:
        for failed, (sink, frame, rows) in wanted.items():
            if sink:
                sink(frame if rows else frame.limit(0), batch)
                delivered[failed] = rows
        failed = None
    finally:
        if failed:
            log.error("batch %d: %s failed after %s", batch.batch_id, failed, delivered)
        if report:
            report(Delivery(batch, scored, delivered, failed))


def fan_out(
    model: PipelineModel, outputs: Outputs, policy: Policy = Policy()
) -> Callable[[DataFrame, int], None]:
    """The per-batch callback.

    The forest runs once: scores are written to the table, and every other
    output reads the few columns it needs back from there. That holds nothing
    in executor memory, lets the alert filter reach the Parquet scan, and
    costs no re-scoring when an executor is lost. The counts that decide which
    outputs have work are observed while the table is written.
    """
    def store(scored: DataFrame, batch: BatchRef) -> DataFrame:
        spark = scored.sparkSession
        if outputs.committed:
            return CommittedTable(spark, outputs.table, schema.SCORED).write(scored, batch)
        files(outputs.table, "parquet")(scored, batch)
        return spark.read.schema(schema.SCORED).parquet(batch.folder(outputs.table))

    def handle(messages: DataFrame, batch_id: int) -> None:
        run = messages.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = BatchRef(run, batch_id)
        decoded, summary = Observation(), Observation()
        inspected = inspect_transactions(messages)
        counted = inspected.observe(decoded, F.count("cause").alias("rejected"))
        if outputs.ids:
            fresh = outputs.ids.unseen(usable(inspected), usable(counted), batch)
        else:
            fresh = usable(counted)
        scored = score(fresh, model, policy)
        stored = store(scored.observe(summary, *alerts.summary_columns()), batch)

        rejected, found = decoded.get["rejected"], summary.get
        log.info("batch %d: %d records, %d rejected", batch_id, found["records"], rejected)
        if found["alerts"]:
            log.warning("batch %d: %d fraud alerts", batch_id, found["alerts"])
        if outputs.ids:
            outputs.ids.add(stored, batch)
        if outputs.profiles:
            at = event_time(F.col("timestamp")).alias("ts")
            outputs.profiles.add(stored.select("user_id", at, "amount"), batch)
        # Every output is written on every attempt: a replay under another threshold or
        # model must not leave what an earlier attempt wrote. One without rows reads none.
        sent = alerts.by_user_and_time(stored, "tx_timestamp") if outputs.in_order else stored
        wanted = {
            "dead_letter": (outputs.dead_letter, dead_letters(inspected), rejected),
            "scored_topic": (outputs.scored_topic, alerts.scored_messages(sent), found["records"]),
            "alerts_topic": (outputs.alerts_topic, alerts.alert_messages(stored), found["alerts"]),
            "cases": (outputs.cases, alerts.fraud_only(stored), found["alerts"]),
        }
        deliver(wanted, batch, found["records"], outputs.report)
        if not found["records"]:
            return
        if outputs.show:
            alerts.preview(stored, outputs.show).show(outputs.show, truncate=False)

    return handle


def start(
    messages: DataFrame,
    model: PipelineModel,
    outputs: Outputs,
    checkpoint: str,
    policy: Policy = Policy(),
    name: str = "scoring",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start scoring; the same ``checkpoint`` resumes where the last run ended."""
    writer = (
        messages.select("value")
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(fan_out(model, outputs, policy))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
