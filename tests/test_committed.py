"""Whole batches for readers, compaction, merged profiles and the delivery report."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskstream import schema
from riskstream.operators import alerts, model, velocity
from riskstream.plans import scoring as plans
from riskstream.sources import events, tables
from riskstream.streaming import scoring, sinks
from riskstream.streaming.committed import CommittedTable, is_committed
from riskstream.streaming.profiles import Profiles
from tests.conftest import TESTDATA

ROW = "id bigint, what string"


def same(left, right):
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def rows(spark, ids, what="new"):
    return spark.createDataFrame([(i, what) for i in ids], ROW)


def values(frame):
    return sorted(map(tuple, frame.collect()))


def files_of(frame):
    return len(frame.inputFiles())


def test_a_reader_sees_old_rows_or_new_ones(spark, tmp_path):
    table = CommittedTable(spark, f"{tmp_path}/t", ROW)
    assert not is_committed(spark, f"{tmp_path}/t") and values(table.read()) == []
    assert values(table.write(rows(spark, range(4), "old"), sinks.BatchRef("q", 0))) == [
        (i, "old") for i in range(4)
    ]
    before = table.read()

    def late(i):
        if i == 3:
            raise OSError("lost")
        return "new"

    broken = rows(spark, range(4)).withColumn("what", F.udf(late)("id"))
    with pytest.raises(Exception, match="lost"):
        table.write(broken, sinks.BatchRef("q", 0))
    assert values(table.read()) == [(i, "old") for i in range(4)]
    table.write(rows(spark, range(3)), sinks.BatchRef("q", 0))
    assert values(table.read()) == [(i, "new") for i in range(3)]
    assert values(before) == [(i, "old") for i in range(4)]  # its files stay
    assert table.vacuum(3600) == 0 and table.vacuum(-60) == 2
    assert values(table.read()) == [(i, "new") for i in range(3)]


def test_many_batches_become_one_file(spark, tmp_path):
    table = CommittedTable(spark, f"{tmp_path}/t", ROW)
    for batch in range(30):
        table.write(rows(spark, [batch, batch + 100]).coalesce(1), sinks.BatchRef("q", batch))
    table.write(rows(spark, [500]).coalesce(1), sinks.BatchRef("other", 0))
    expected, reading = values(table.read()), table.read()
    assert table.compact() == 29 and table.compact() == 0
    assert values(table.read()) == expected == values(reading)
    assert files_of(table.read()) == 3  # the newest batch of each run stays as it is
    # The newest batch may still be replayed; what follows is compacted in its turn.
    table.write(rows(spark, [29], "replayed").coalesce(1), sinks.BatchRef("q", 29))
    for batch in range(30, 33):
        table.write(rows(spark, [batch]).coalesce(1), sinks.BatchRef("q", batch))
    expected = values(table.read())
    assert (129, "new") not in expected and (29, "replayed") in expected
    assert table.compact() == 3 and values(table.read()) == expected
    assert table.vacuum(-60) > 30 and values(table.read()) == expected
    assert files_of(table.read()) == 4


def test_profiles_equal_the_whole_table(spark, tmp_path):
    draw = random.Random(4)
    day = dt.datetime(2024, 1, 1)
    made = [
        (
            draw.choice(["busy", "busy", "a", None]),
            None if i % 90 == 5 else day + dt.timedelta(seconds=draw.randrange(0, 200_000)),
            draw.choice([1.25, 99.99, None, float("inf") if i % 40 == 0 else 7.0]),
        )
        for i in range(900)
    ]
    made += [("unpriced", day, None), ("early", day - dt.timedelta(days=30_000), 2.5)]
    kinds = "user_id string, ts timestamp, amount double"
    profiles = Profiles(spark, f"{tmp_path}/p")
    parts = [made[k::6] for k in range(6)]
    for batch in (4, 0, 2, 0, 1, 5, 3, 5):  # any order, and again
        profiles.add(spark.createDataFrame(parts[batch], kinds), sinks.BatchRef("q", batch))
    whole = spark.createDataFrame(made, kinds)
    for seconds in (velocity.HOUR, 6 * velocity.HOUR):
        same(profiles.read(seconds), velocity.tumbling(whole, seconds))
    assert profiles.compact() == 5
    same(profiles.read(), velocity.tumbling(whole))
    stored = profiles.table.read()
    assert stored.count() < len(made) and stored.where("odd > 0").count() > 0
    with pytest.raises(ValueError, match="multiple"):
        profiles.read(1800)


@pytest.fixture(scope="module")
def transactions(spark):
    return events.transactions(spark, f"{TESTDATA}/sf0.001")


def handled(spark, outputs, keep="true", batch_id=0):
    """Hand a batch to the scoring callback in a session of its own, as a stream does.

    The evaluator of a fit can't be sent to tasks from a session that has observed a frame.
    """
    own = spark.newSession()
    frame = events.transactions(own, f"{TESTDATA}/sf0.001").where(keep)
    handle = scoring.fan_out(model.pinned(spark), outputs)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    try:
        handle(alerts.transaction_messages(frame), batch_id)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def test_scores_and_profiles_of_a_committed_table(spark, transactions, tmp_path):
    profiles = Profiles(spark, f"{tmp_path}/profiles")
    outputs = scoring.Outputs(
        table=f"{tmp_path}/scored", show=0, committed=True, profiles=profiles,
        alerts_topic=sinks.files(f"{tmp_path}/alerts", "parquet"),
    )
    handled(spark, outputs, "event_id % 2 = 0", 0)
    handled(spark, outputs, "event_id % 2 = 1", 1)
    handled(spark, outputs, "event_id % 2 = 1", 1)
    expected = plans.scored(alerts.transaction_messages(transactions), model.pinned(spark))
    same(tables.scored_table(spark, outputs.table), expected)
    assert CommittedTable(spark, outputs.table, schema.SCORED).compact() == 1
    same(tables.scored_table(spark, outputs.table), expected)
    same(spark.read.parquet(f"{tmp_path}/alerts/run=*/batch_id=*"), alerts.alert_messages(expected))
    same(profiles.read(), velocity.tumbling(transactions))


def test_a_failed_output_is_reported(spark, tmp_path):
    def full(frame, batch):
        raise OSError("no room")

    reports = []
    outputs = scoring.Outputs(
        table=f"{tmp_path}/scored", show=0, report=reports.append,
        scored_topic=sinks.files(f"{tmp_path}/topic", "parquet"),
        alerts_topic=full, cases=sinks.files(f"{tmp_path}/cases", "json"),
    )
    with pytest.raises(OSError, match="no room"):
        handled(spark, outputs)
    (report,) = reports
    assert (report.batch.batch_id, report.scored, report.failed) == (0, 1000, "alerts_topic")
    assert report.delivered == {"scored_topic": 1000}
    handled(spark, scoring.Outputs(
        table=f"{tmp_path}/scored", show=0, report=reports.append,
        cases=sinks.files(f"{tmp_path}/cases", "json"),
    ))
    assert reports[1].failed is None and reports[1].scored == 1000
    assert reports[1].delivered["cases"] == spark.read.json(f"{tmp_path}/cases/run=*/*").count()
