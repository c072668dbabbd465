"""Redelivered transactions are stored, sent and counted once; streams as one job."""

import time

import pytest
from pyspark.sql import functions as F

from riskstream import schema
from riskstream.operators import alerts, model
from riskstream.plans import scoring as plans
from riskstream.sources import events
from riskstream.streaming import scoring, sinks, supervise
from riskstream.streaming.stored import StoredIds
from tests.conftest import TESTDATA


@pytest.fixture(scope="module")
def transactions(spark):
    return events.transactions(spark, f"{TESTDATA}/sf0.001")


@pytest.fixture()
def run(spark, tmp_path):
    """Hand batches to the scoring callback, as the query of a given id would."""
    ids = StoredIds(f"{tmp_path}/ids", bitmaps=16)
    outputs = scoring.Outputs(
        table=f"{tmp_path}/scored", alerts_topic=sinks.files(f"{tmp_path}/alerts", "parquet"),
        show=0, ids=ids,
    )
    handle = scoring.fan_out(model.pinned(spark), outputs)

    def one(rows, batch_id, query="q"):
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", query)
        try:
            handle(alerts.transaction_messages(rows), batch_id)
        finally:
            spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
        return ids.read_days

    return one


def stored(spark, tmp_path):
    return spark.read.schema(schema.SCORED).parquet(f"{tmp_path}/scored/run=*/batch_id=*")


def same(left, right):
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_redelivery_adds_no_row_and_reads_only_its_day(spark, transactions, tmp_path, run):
    day = F.date_format("ts", "yyyy-MM-dd")
    early = transactions.where(day < "2024-01-10")
    late = transactions.where((day >= "2024-01-10") & (day != "2024-01-20"))
    assert run(early, 0) == []
    assert run(late, 1) == []  # days of its own: no ids are read
    again = early.where(day == "2024-01-03").limit(5)
    assert run(again.unionByName(transactions.where(day == "2024-01-20")), 2) == ["2024-01-03"]
    same(stored(spark, tmp_path), plans.scored(alerts.transaction_messages(transactions), model.pinned(spark)))
    sent = spark.read.parquet(f"{tmp_path}/alerts/run=*/batch_id=*")
    same(sent, alerts.alert_messages(stored(spark, tmp_path)))


def test_copies_within_a_batch_and_replays(spark, transactions, tmp_path, run):
    some = transactions.limit(300)
    run(some.unionByName(some), 0)
    assert stored(spark, tmp_path).count() == 300
    run(some.unionByName(some), 0)  # a replay does not see its own entry
    assert stored(spark, tmp_path).count() == 300
    run(some, 1)
    run(some, 0, query="restarted with a new checkpoint")
    assert stored(spark, tmp_path).count() == 300


def test_rows_without_id_all_pass(spark, transactions, tmp_path, run):
    some = transactions.limit(20).withColumn("transaction_id", F.lit(None).cast("string"))
    run(some, 0)
    run(some, 1)
    assert stored(spark, tmp_path).count() == 40


def test_full_filters_lose_nothing(spark, transactions, tmp_path):
    """With every bit set ids are read, and only real copies go."""
    ids = StoredIds(f"{tmp_path}/ids", bitmaps=1)
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("2024-05-05T01:02:03").alias("timestamp"),
    )
    old, new = rows.where("id % 2 = 0"), rows
    old, new = (f.select("transaction_id", "timestamp") for f in (old, new))
    ids.add(old, sinks.BatchRef("q", 0))
    left = ids.unseen(new, new, sinks.BatchRef("q", 1))
    assert left.count() == 30_000 and ids.read_days == ["2024-05-05"]
    assert left.join(old, "transaction_id").isEmpty()


def test_a_busy_user_is_published_in_order_by_several_tasks(spark, transactions, tmp_path):
    busy = transactions.withColumn(
        "user_id", F.when(F.col("event_id") % 3 > 0, F.lit("busy")).otherwise(F.col("user_id"))
    )
    made = alerts.by_user_and_time(busy, "ts").withColumn("task", F.spark_partition_id())
    joins_small_parts = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(joins_small_parts, "false")
    try:
        parts = made.select("task", "user_id", "ts").toPandas()
    finally:
        spark.conf.unset(joins_small_parts)
    for _, own in parts.groupby(["task", "user_id"]):
        assert own["ts"].is_monotonic_increasing
    spans = [(p["ts"].min(), p["ts"].max()) for _, p in parts[parts["user_id"] == "busy"].groupby("task")]
    assert len(spans) > 1
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_a_failed_stream_ends_the_others(spark):
    def broken(batch, batch_id):
        raise OSError("no room")

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    endless = ticks.writeStream.format("noop").start()
    failing = ticks.writeStream.foreachBatch(broken).start()
    began = time.monotonic()
    with pytest.raises(Exception, match="no room"):
        supervise.until_all_end([endless, failing])
    assert time.monotonic() - began < 60 and not endless.isActive
