import glob
import json
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from riskstream import schema
from riskstream.config import Policy, StreamConfig
from riskstream.jobs import generate, score, watch_alerts
from riskstream.operators import alerts, datagen, dedup, model, velocity
from riskstream.operators.decode import decode_transactions
from riskstream.plans import scoring as plans
from riskstream.sources import events, streams
from riskstream.streaming import alerts as alert_stream
from riskstream.streaming import scoring, sinks
from tests.conftest import TESTDATA

ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def transactions(spark):
    return events.transactions(spark, f"{TESTDATA}/sf0.001")


def same(left, right):
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def outputs(root):
    return scoring.Outputs(
        table=f"{root}/scored",
        scored_topic=sinks.files(f"{root}/scored-topic", "parquet"),
        alerts_topic=sinks.files(f"{root}/alerts-topic", "parquet"),
        cases=sinks.files(f"{root}/cases", "json"),
        dead_letter=sinks.files(f"{root}/dead", "json"),
        show=0,
    )


def run(spark, root, source, per_trigger=None):
    query = scoring.start(
        streams.file_stream(spark, source, per_trigger=per_trigger),
        model.pinned(spark),
        outputs(root),
        checkpoint=f"{root}/checkpoint",
        trigger=ONCE,
    )
    query.awaitTermination()
    return query


@pytest.fixture(scope="module")
def scored_run(spark, transactions, tmp_path_factory):
    """1,000 messages in five files and two unusable ones, in several batches."""
    root = str(tmp_path_factory.mktemp("stream"))
    messages = alerts.transaction_messages(transactions)
    messages.select("value").repartition(5).write.text(f"{root}/in")
    with open(f"{root}/in/bad.txt", "w") as bad:
        bad.write('not json\n{"transaction_id":"x"}\n')
    query = run(spark, root, f"{root}/in", per_trigger=2)
    assert query.lastProgress is not None
    return root, messages


def stored(spark, root):
    return spark.read.schema(schema.SCORED).parquet(f"{root}/scored/run=*/batch_id=*")


def test_stream_equals_batch(spark, scored_run):
    root, messages = scored_run
    assert len(glob.glob(f"{root}/scored/run=*/batch_id=*")) == 3
    same(stored(spark, root), plans.scored(messages, model.pinned(spark)))


def test_topics_and_cases(spark, scored_run):
    root, messages = scored_run
    batch = plans.scored(messages, model.pinned(spark))
    sent = spark.read.parquet(f"{root}/scored-topic/run=*/batch_id=*")
    same(sent, alerts.scored_messages(batch))
    frauds = alerts.fraud_only(batch)
    assert frauds.count() > 0
    sent = spark.read.parquet(f"{root}/alerts-topic/run=*/batch_id=*")
    same(sent, alerts.alert_messages(batch))
    cases = spark.read.schema(schema.SCORED).json(f"{root}/cases/run=*/batch_id=*")
    same(cases.select("transaction_id", "reason"), frauds.select("transaction_id", "reason"))


def test_dead_letters(spark, scored_run):
    root, _ = scored_run
    dead = spark.read.schema(schema.DEAD_LETTER).json(f"{root}/dead/run=*/batch_id=*")
    assert sorted(r.cause for r in dead.collect()) == ["malformed json", "missing amount"]


def test_restart_reads_nothing_twice(spark, scored_run):
    root, _ = scored_run
    before = stored(spark, root).count()
    run(spark, root, f"{root}/in")
    assert stored(spark, root).count() == before
    with open(f"{root}/in/more.txt", "w") as more:
        more.write("still not json\n")
    run(spark, root, f"{root}/in")
    assert stored(spark, root).count() == before
    # The query keeps its id, so all its batches are in one folder.
    assert len(glob.glob(f"{root}/scored/run=*")) == 1


def test_replayed_batch_leaves_one_copy(spark, transactions, tmp_path):
    handle = scoring.fan_out(model.pinned(spark), outputs(tmp_path))
    context = spark.sparkContext
    context.setLocalProperty("sql.streaming.queryId", "q1")
    try:
        batch = alerts.transaction_messages(transactions)
        handle(batch, 0)
        handle(batch, 0)
        assert stored(spark, tmp_path).count() == 1000
        context.setLocalProperty("sql.streaming.queryId", "q2")
        handle(batch, 0)
        assert stored(spark, tmp_path).count() == 2000
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)


def test_failed_batch_is_finished_after_a_restart(spark, transactions, tmp_path):
    """A run that dies between two sinks leaves no gap and no second copy."""
    messages = alerts.transaction_messages(transactions)
    messages.select("value").coalesce(2).write.text(f"{tmp_path}/in")
    whole = outputs(tmp_path)

    def broken(frame, batch):
        raise OSError("topic is gone")

    def start(to):
        return scoring.start(
            streams.file_stream(spark, f"{tmp_path}/in"),
            model.pinned(spark),
            to,
            checkpoint=f"{tmp_path}/checkpoint",
            trigger=ONCE,
        )

    with pytest.raises(Exception, match="topic is gone"):
        start(replace(whole, alerts_topic=broken)).awaitTermination()
    assert stored(spark, tmp_path).count() == 1000
    start(whole).awaitTermination()
    batch = plans.scored(messages, model.pinned(spark))
    same(stored(spark, tmp_path), batch)
    sent = spark.read.parquet(f"{tmp_path}/alerts-topic/run=*/batch_id=*")
    same(sent, alerts.alert_messages(batch))


def test_empty_batches(spark, tmp_path):
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    try:
        handle = scoring.fan_out(model.pinned(spark), outputs(tmp_path))
        empty = spark.createDataFrame([], schema.MESSAGE)
        handle(empty, 0)
        handle(empty.where("false"), 1)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert stored(spark, tmp_path).count() == 0


def test_batch_of_rejects_only(spark, tmp_path):
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    try:
        bad = spark.createDataFrame([(None, "broken")], schema.MESSAGE)
        scoring.fan_out(model.pinned(spark), outputs(tmp_path))(bad, 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    sent = spark.read.schema(schema.MESSAGE).parquet(f"{tmp_path}/alerts-topic/run=q/batch_id=0")
    assert sent.count() == 0
    assert spark.read.schema(schema.DEAD_LETTER).json(f"{tmp_path}/dead/run=q/batch_id=0").count() == 1


def test_alert_feed(spark, scored_run, tmp_path):
    root, messages = scored_run
    query = alert_stream.start(
        streams.file_stream(spark, f"{root}/alerts-topic/run=*/batch_id=*", "parquet"),
        feed=sinks.files(f"{tmp_path}/feed", "json"),
        rejected=sinks.files(f"{tmp_path}/rejected", "json"),
        checkpoint=f"{tmp_path}/checkpoint",
        trigger=ONCE,
    )
    query.awaitTermination()
    feed = spark.read.json(f"{tmp_path}/feed/run=*/batch_id=*")
    expected = alert_stream.read_alerts(
        alerts.alert_messages(plans.scored(messages, model.pinned(spark)))
    )
    same(feed.select("alert_text", "warning"), expected.select("alert_text", "warning"))


def windows(spark, transactions, tmp_path, build, mode):
    """Run a windowed operator over a file stream; return its last state."""
    source = f"{tmp_path}/rows"
    transactions.select("transaction_id", "user_id", "ts", "amount").write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    target = f"{tmp_path}/out"

    def write(frame, batch_id):
        frame.write.mode("overwrite" if mode == "complete" else "append").parquet(target)

    query = (
        build(stream.withWatermark("ts", "1 hour"))
        .writeStream.outputMode(mode)
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .foreachBatch(write)
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(target)


def burst_windows(transactions):
    return velocity.bursts(velocity.sliding(transactions), 2)


@pytest.mark.parametrize("build", [velocity.tumbling, velocity.sliding, burst_windows])
def test_windows_in_a_stream(spark, transactions, tmp_path, build):
    found = windows(spark, transactions, tmp_path, build, "complete")
    same(found, build(transactions))


def test_closed_sessions_in_a_stream(spark, transactions, tmp_path):
    found = windows(spark, transactions, tmp_path, velocity.sessions, "append")
    batch = velocity.sessions(transactions)
    assert found.exceptAll(batch).isEmpty()
    # Only sessions the watermark has not closed yet are missing.
    assert 0 < batch.count() - found.count() < 20


def test_stream_dedup(spark, transactions, tmp_path):
    def build(stream):
        twice = stream.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
        return dedup.stream_copies(twice.drop("copy"), "transaction_id")

    found = windows(spark, transactions, tmp_path, build, "append")
    same(found.select("transaction_id"), transactions.select("transaction_id"))


def test_topic_options():
    config = StreamConfig(bootstrap_servers="b:1")
    assert streams.kafka_options(config, "t", per_trigger=10) == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
    }
    assert sinks.kafka_options(config, "t") == {"kafka.bootstrap.servers": "b:1", "topic": "t"}


def test_live_generation(spark, tmp_path):
    made = datagen.transactions(streams.paced_ids(spark, 0.01))
    lines = alerts.transaction_messages(made).select("value")
    query = (
        lines.writeStream.format("text")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .start(f"{tmp_path}/out")
    )
    try:
        deadline = time.monotonic() + 60
        while time.monotonic() < deadline:
            if query.lastProgress and query.lastProgress["sink"]["numOutputRows"] != 0:
                if glob.glob(f"{tmp_path}/out/_spark_metadata/1"):
                    break
            time.sleep(0.2)
    finally:
        query.stop()
    sent = decode_transactions(spark.read.text(f"{tmp_path}/out"))
    assert not sent.isEmpty()
    assert sent.count() == spark.read.text(f"{tmp_path}/out").count()


def test_generator_wants_a_count_or_live():
    for wrong in ([], ["5", "--live"]):
        with pytest.raises(SystemExit):
            generate.main(wrong)


def test_jobs_end_to_end(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("PROCESSED_DATA_PATH", f"{tmp_path}/processed")
    monkeypatch.setenv("FRAUD_CASES_PATH", f"{tmp_path}/cases")
    monkeypatch.setenv("DEAD_LETTER_PATH", f"{tmp_path}/dead")
    monkeypatch.setenv("CHECKPOINT_DIR", f"{tmp_path}/checkpoints")
    monkeypatch.setenv("MODEL_PATH", model.PINNED)
    generate.main(["2000", "--sink", f"{tmp_path}/in"])
    score.main(["--source", f"{tmp_path}/in", "--sink", f"{tmp_path}/topics", "--once"])
    watch_alerts.main(
        [
            f"{tmp_path}/alerts",
            "--source", f"{tmp_path}/topics/fraud-alerts/run=*/batch_id=*",
            "--once",
        ]
    )
    sent = decode_transactions(spark.read.text(f"{tmp_path}/in")).count()
    assert sent > 2000
    table = spark.read.parquet(f"{tmp_path}/processed")
    assert table.count() == sent and {"run", "batch_id"} <= set(table.columns)
    cases = alerts.fraud_only(table).count()
    assert cases > 0
    lines = [
        json.loads(line)
        for path in glob.glob(f"{tmp_path}/alerts/feed/run=*/batch_id=*/*.json")
        for line in open(path)
    ]
    assert len(lines) == cases
    assert lines[0]["alert_text"].startswith("Transaction ID: ")


def test_replay_under_another_threshold_leaves_nothing_stale(spark, transactions, tmp_path):
    batch = alerts.transaction_messages(transactions)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    try:
        scoring.fan_out(model.pinned(spark), outputs(tmp_path))(batch, 0)
        cases = spark.read.schema(schema.SCORED).json(f"{tmp_path}/cases/run=*/batch_id=*")
        assert cases.count() > 0
        strict = Policy(fraud_threshold=1.0)
        scoring.fan_out(model.pinned(spark), outputs(tmp_path), strict)(batch, 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    for name, kind in (("cases", "json"), ("alerts-topic", "parquet"), ("dead", "json")):
        left = spark.read.schema("value string").format(kind).load(f"{tmp_path}/{name}/run=*/batch_id=*")
        assert left.count() == 0
    assert stored(spark, tmp_path).where("prediction = 'FRAUD'").count() == 0
