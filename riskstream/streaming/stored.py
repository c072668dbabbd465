"""Which transactions are stored already, so that a redelivery adds no row.

A copy of a message has its id and its time, so ids are kept by day. Beside a day's ids
lies a filter: bitmaps in which each id sets two bits. A batch asks the filters of its own
days; only where an id may be known are that day's ids read and compared. Days of new
transactions are seldom read, days long past not at all. Filters are joined to the ids
by bitmap, never gathered.

An entry belongs to a run and a batch, and a replayed batch overwrites its own and does not
see it. Rows without an id or a readable time can't be told to be copies: all pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.functions.features import event_time
from riskstream.streaming.sinks import BatchRef

BITS = 1 << 15  # of one bitmap
BITMAPS = 1024  # of a day: 16 bits for each of two million ids


class StoredIds:
    """The index of stored ids under ``root``, a folder all executors share."""

    def __init__(self, root: str, bitmaps: int = BITMAPS) -> None:
        self.root, self.bitmaps = root, bitmaps
        # The days whose ids the last batch had to read.
        self.read_days: list[str] = []

    def _bits(self) -> list[Column]:
        """A bitmap's number, and two places in it."""
        hashed = F.xxhash64("transaction_id")
        places = [F.pmod(F.shiftrightunsigned(hashed, n), F.lit(BITS)) for n in (16, 40)]
        return [F.pmod(hashed, F.lit(self.bitmaps)).alias("bitmap"), F.array(*places).alias("bits")]

    def _of_days(self, spark: SparkSession, kind: str, days: list[str], schema: str, batch):
        """Entries of some days, but for the batch's own; nothing else is listed.

        One scan for all days, so that their small files share tasks.
        """
        folders = [f"{self.root}/{kind}/day={day}" for day in days]
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files = path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        folders = [folder for folder in folders if files.exists(path(folder))]
        if not folders:
            return None
        found = spark.read.schema(f"{schema}, day string, run string, batch_id bigint").option(
            "basePath", f"{self.root}/{kind}"
        ).parquet(*folders)
        return found.where(~((F.col("run") == batch.run) & (F.col("batch_id") == batch.batch_id)))

    @staticmethod
    def _day(timestamp: Column) -> Column:
        return F.date_format(event_time(timestamp), "yyyy-MM-dd")

    def unseen(self, rows: DataFrame, ids: DataFrame, batch: BatchRef) -> DataFrame:
        """The rows whose ids no other batch has stored, one of each id.

        ``ids`` are the same rows, of which only id and time are used: it runs first.
        """
        spark = rows.sparkSession
        pending = f"{self.root}/pending/run={batch.run}"
        keyed = ids.select("transaction_id", self._day(F.col("timestamp")).alias("day"))
        keyed.where("transaction_id is not null and day is not null").write.mode(
            "overwrite"
        ).parquet(pending)
        asked = spark.read.schema("transaction_id string, day string").parquet(pending)
        # A batch has few days, whatever its size.
        days = sorted(r.day for r in asked.select("day").distinct().collect())
        known = self._known(spark, asked, days, batch)
        name = F.coalesce(
            F.concat(F.lit("id "), "transaction_id"),
            F.concat(F.lit("none "), F.monotonically_increasing_id().cast("string")),
        )
        rest = [c for c in rows.columns if c != "timestamp"]
        first = rows.groupBy(name.alias("copy_of")).agg(
            F.min(F.struct("timestamp", *rest)).alias("first")
        ).select("first.*").select(rows.columns)
        if known is None:
            return first
        same = (F.col("transaction_id") == F.col("known")) & (
            self._day(F.col("timestamp")) == F.col("day")
        )
        # Joined by sorting: a broadcast would pass the ids through the driver in every batch.
        known = known.withColumnRenamed("transaction_id", "known").hint("merge")
        return first.join(known, same, "left_anti")

    def _known(self, spark, asked: DataFrame, days: list[str], batch: BatchRef) -> DataFrame | None:
        self.read_days = []
        filters = self._of_days(spark, "filters", days, "bitmap bigint, bits binary", batch)
        if filters is None:
            return None
        whole = filters.groupBy("day", "bitmap").agg(F.bitmap_or_agg("bits").alias("held"))
        placed = asked.select("transaction_id", "day", *self._bits())

        def is_set(place: Column) -> Column:
            octet = F.substring("held", (F.floor(place / 8) + 1).cast("int"), F.lit(1))
            bit = F.pmod(place, F.lit(8)).cast("int")
            return F.getbit(F.conv(F.hex(octet), 16, 10).cast("bigint"), bit) == 1

        suspects = placed.join(whole.hint("merge"), ["day", "bitmap"]).where(
            is_set(F.col("bits")[0]) & is_set(F.col("bits")[1])
        )
        self.read_days = sorted(r.day for r in suspects.select("day").distinct().collect())
        stored = self._of_days(spark, "ids", self.read_days, "transaction_id string", batch)
        return None if stored is None else stored.select("transaction_id", "day").distinct()

    def add(self, stored: DataFrame, batch: BatchRef) -> None:
        """Remember what a batch has stored."""
        entry = [F.lit(batch.run).alias("run"), F.lit(batch.batch_id).cast("bigint").alias("batch_id")]
        day = self._day(F.col("timestamp")).alias("day")
        ids = stored.select("transaction_id", day, *entry).where(
            "transaction_id is not null and day is not null"
        )
        bits = ids.select("day", "run", "batch_id", *self._bits())
        filters = bits.withColumn("bit", F.explode("bits")).groupBy(
            "day", "run", "batch_id", "bitmap"
        ).agg(F.bitmap_construct_agg("bit").alias("bits"))
        for kind, frame in (("ids", ids), ("filters", filters)):
            writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("day", "run", "batch_id").parquet(f"{self.root}/{kind}")
