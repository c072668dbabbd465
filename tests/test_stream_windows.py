"""What a stream says of a user beside each transaction, over several batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskstream.operators import velocity

ROWS = "transaction_id string, user_id string, ts timestamp, amount double"
DAY = dt.datetime(2024, 3, 1, tzinfo=dt.UTC)


@pytest.fixture(scope="module")
def rows():
    """Two days: a busy user, ties, rows without user or time, odd amounts."""
    draw = random.Random(5)
    found = []
    for i in range(1500):
        user = draw.choice(["busy"] * 5 + ["a", "b", None])
        second = draw.choice([draw.randrange(0, 172_800), draw.randrange(0, 48) * 3600])
        amount = draw.choice([1.25, 10.0, 99.99, None, float("inf") if i % 50 == 0 else 3.0])
        ts = None if i % 300 == 7 else DAY + dt.timedelta(seconds=second)
        found.append((str(i), user, ts, amount))
    return sorted(found, key=lambda r: (r[2] is not None, r[2] or DAY))


def streamed(spark, rows, tmp_path, build):
    """Run a stream of six files, one a batch; return all it wrote and the whole batch table."""
    for part in range(6):
        frame = spark.createDataFrame(rows[part * 250 : (part + 1) * 250], ROWS)
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={batch_id}")

    query = (
        build(stream.withWatermark("ts", "1 hour")).writeStream.outputMode("append")
        .option("checkpointLocation", f"{tmp_path}/checkpoint").foreachBatch(write)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    states = query.lastProgress["stateOperators"]
    return spark.read.parquet(f"{tmp_path}/out").drop("batch_id"), states


def closed(spark, rows, hours):
    last = max(r[2] for r in rows if r[2])
    return (F.col("ts") <= last - dt.timedelta(hours=hours)) | F.col("ts").isNull()


def same(left, right):
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_trailing_in_a_stream(spark, rows, tmp_path):
    found, states = streamed(spark, rows, tmp_path, velocity.trailing)
    batch = velocity.trailing(spark.createDataFrame(rows, ROWS))
    assert found.exceptAll(batch).isEmpty()
    same(found.where(closed(spark, rows, 7)), batch.where(closed(spark, rows, 7)))
    # What is held is a few hours of two days.
    assert max(s["numRowsTotal"] for s in states) < 10_000


def test_trailing_of_a_length_no_pane_divides(spark, rows, tmp_path):
    found, _ = streamed(spark, rows, tmp_path, lambda s: velocity.trailing(s, 5000.7))
    batch = velocity.trailing(spark.createDataFrame(rows, ROWS), 5000.7)
    assert found.exceptAll(batch).isEmpty() and found.count() > 1300


def test_profile_in_a_stream(spark, rows, tmp_path):
    found, states = streamed(spark, rows, tmp_path, velocity.with_profile)
    batch = velocity.with_profile(spark.createDataFrame(rows, ROWS))
    assert found.exceptAll(batch).isEmpty()
    same(found.where(closed(spark, rows, 13)), batch.where(closed(spark, rows, 13)))
    assert not found.where("user_id is null and user_n is null and ts is not null").isEmpty()
    assert max(s["numRowsTotal"] for s in states) < 2000
