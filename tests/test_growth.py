"""What one task reads, or the driver is sent, doesn't grow with the table."""

from pyspark.sql import functions as F

from riskstream.operators import velocity
from riskstream.plans import queries
from riskstream.streaming import committed, sinks
from riskstream.streaming.stored import StoredIds


def test_known_ids_are_read_by_one_scan_and_not_broadcast(spark, tmp_path):
    ids = StoredIds(f"{tmp_path}/ids", bitmaps=4)
    day = F.concat(F.lit("2024-05-0"), (F.col("id") % 3 + 1).cast("string"), F.lit("T01:02:03"))
    rows = spark.range(60).select(F.col("id").cast("string").alias("transaction_id"), day.alias("timestamp"))
    ids.add(rows.where("transaction_id < '5'"), sinks.BatchRef("q", 0))
    days = [f"2024-05-0{n}" for n in (1, 2, 3, 9)]
    read = ids._of_days(spark, "ids", days, "transaction_id string", sinks.BatchRef("q", 1))
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    left = ids.unseen(rows, rows, sinks.BatchRef("q", 1))
    assert "Broadcast" not in left._jdf.queryExecution().executedPlan().toString()
    old = {r[0] for r in rows.where("transaction_id < '5'").collect()}
    assert {r.transaction_id for r in left.collect()} == {str(n) for n in range(60)} - old
    assert ids.read_days == days[:3]


def test_a_compaction_writes_files_by_size(spark, tmp_path, monkeypatch):
    table = committed.CommittedTable(spark, f"{tmp_path}/t", "id bigint")
    for batch in range(3):
        table.write(spark.range(batch * 1000, batch * 1000 + 1000), sinks.BatchRef("q", batch))
    monkeypatch.setattr(committed, "FILE_BYTES", 2000, raising=False)
    assert table.compact() == 2
    (folder,) = table._state()[0]["folders"]
    assert len(spark.read.parquet(f"{tmp_path}/t/{folder}").inputFiles()) > 3
    assert sorted(r.id for r in table.read().collect()) == list(range(3000))


def test_each_part_is_a_batch_of_several_files(spark, tmp_path):
    rows = spark.range(0, 400, 1, 4).selectExpr("id", "nullif(id % 5, 4) as part")
    parts = [F.col("part") == n for n in (2, 0, 7, 1)]  # the third has no row
    parts.append(F.col("id") == 3)
    seen = []

    def look(batch, batch_id):
        found = batch.select("id", F.input_file_name().alias("file")).collect()
        seen.append((len({r.file for r in found}), sorted(r.id for r in found)))

    query = (
        queries._stream_of_parts(rows, parts).writeStream.foreachBatch(look)
        .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    whole = [sorted(n for n in range(400) if n % 5 == k) for k in range(3)]
    assert [ids for _, ids in seen] == [whole[2], whole[0], [], whole[1], [3]]
    assert [files for files, _ in seen] == [4, 4, 0, 4, 1]


def test_a_streamed_transaction_is_held_in_few_rows(spark, tmp_path):
    rows = spark.range(200).selectExpr(
        "id as event_id", "concat('u', id) as user_id",
        "timestamp'2024-03-01 10:00:00' + make_interval(0, 0, 0, 0, 0, id % 100) as ts",
        "1.5D as amount",
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    trailed = velocity.trailing(stream.withWatermark("ts", "1 hour"), keep=("event_id",))
    query = (
        trailed.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    # Two ends and up to two blocks of its window, its instant and its pane.
    held = sum(state["numRowsTotal"] for state in query.lastProgress["stateOperators"])
    assert 200 * 4 < held <= 200 * 6
