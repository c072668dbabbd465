"""Users' windows as they close, and beside them the rows that came too late for theirs.

A windowed sum drops rows whose window the watermark has passed, and says only how many.
Here the same query also carries its rows to the callback, which keeps those that the
sum did not take. The watermark that decides in a batch is the one of the batch
before, so it follows from the latest event times of the batches up to two before: each
batch's latest is kept with its output, and a replay or a restart decides alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.operators import velocity
from riskstream.streaming.sinks import BatchRef

_SEEN = "latest bigint, run string, batch_id bigint"


def _watermark(spark: SparkSession, folder: str, batch: BatchRef, delay_ms: int) -> int | None:
    """In milliseconds; None before any has been set."""
    if batch.batch_id < 2:
        return None
    # One row a batch, of which only the largest number comes back.
    seen = spark.read.schema(_SEEN).parquet(f"{folder}/seen")
    earlier = seen.where((F.col("run") == batch.run) & (F.col("batch_id") <= batch.batch_id - 2))
    latest = earlier.agg(F.max("latest")).collect()[0][0]
    return None if latest is None else latest // 1000 - delay_ms


def is_late(ts: Column, seconds: float, watermark_ms: int | None) -> Column:
    """Whether the tumbling window that holds ``ts`` had closed by the watermark."""
    if watermark_ms is None:
        return F.lit(False)
    length = round(seconds * velocity.SECOND)
    at = F.unix_micros(ts)
    ends = at - F.pmod(at, F.lit(length)) + length
    return F.coalesce(ends <= watermark_ms * 1000, F.lit(False))


def start(
    transactions: DataFrame, folder: str, checkpoint: str, delay_seconds: int = 3600,
    seconds: float = 6 * velocity.HOUR, name: str = "windows", trigger: dict | None = None,
) -> StreamingQuery:
    """Write closed windows and late rows to ``folder``, whence ``windows`` and ``late_rows`` read."""
    rows = transactions.withWatermark("ts", f"{delay_seconds} seconds")
    windows = velocity.tumbling(rows, seconds)
    window, row = (F.struct(*f.columns) for f in (windows, rows))
    kinds = [f.select(F.struct("*").alias("x")).schema["x"].dataType for f in (windows, rows)]
    both = windows.select(window.alias("window"), F.lit(None).cast(kinds[1]).alias("row")).union(
        rows.select(F.lit(None).cast(kinds[0]).alias("window"), row.alias("row"))
    )

    def handle(frame: DataFrame, batch_id: int) -> None:
        spark = frame.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = BatchRef(run, batch_id)
        passed = _watermark(spark, folder, batch, delay_seconds * 1000)
        seen = Observation()
        latest = F.max(F.unix_micros("row.ts")).alias("latest")
        late = F.col("row").isNotNull() & is_late(F.col("row.ts"), seconds, passed)
        kept = frame.observe(seen, latest).where(F.col("window").isNotNull() | late)
        # One write, so that the windows are computed once.
        kept.write.mode("overwrite").parquet(batch.folder(f"{folder}/closed"))
        made = spark.createDataFrame([(seen.get["latest"], run, batch_id)], _SEEN)
        made.coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("run", "batch_id").parquet(f"{folder}/seen")

    writer = (
        both.writeStream.queryName(name).outputMode("append")
        .option("checkpointLocation", checkpoint).foreachBatch(handle)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def _closed(spark: SparkSession, folder: str, column: str) -> DataFrame:
    written = spark.read.parquet(f"{folder}/closed/run=*/batch_id=*")
    return written.where(F.col(column).isNotNull()).select(f"{column}.*")


def windows(spark: SparkSession, folder: str) -> DataFrame:
    """The closed windows."""
    return _closed(spark, folder, "window")


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that no window counts."""
    return _closed(spark, folder, "row")
