"""Late rows beside closed windows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from riskstream.operators import velocity
from riskstream.streaming import late

ROWS = "event_id long, user_id string, ts timestamp, amount double"
DAY = dt.datetime(2024, 3, 1, tzinfo=dt.UTC)


def test_windows_and_late_rows_account_for_every_row(spark, tmp_path):
    """Files out of order, a restart in between, rows without a time."""
    draw = random.Random(6)
    rows = []
    for i in range(900):
        hour = i / 15 - (draw.choice([0, 0, 0, 9, 30]) if i % 3 == 0 else 0)
        ts = None if i % 100 == 3 else DAY + dt.timedelta(seconds=round(hour * 3600, 3))
        rows.append((i, draw.choice("abc"), ts, 1.0))

    def deliver(parts):
        for part in parts:
            frame = spark.createDataFrame(rows[part * 100 : (part + 1) * 100], ROWS)
            frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1)
        late.start(
            stream.parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint",
            trigger={"availableNow": True},
        ).awaitTermination()

    deliver(range(5))
    deliver(range(5, 9))
    found = late.windows(spark, f"{tmp_path}/out")
    dropped = late.late_rows(spark, f"{tmp_path}/out")
    assert dropped.count() > 30 and dropped.count() == dropped.select("event_id").distinct().count()
    table = spark.createDataFrame(rows, ROWS)
    taken = table.join(dropped.select("event_id"), "event_id", "left_anti")
    expected = velocity.tumbling(taken)
    # Every closed window counts all rows that are not listed as late, and no other.
    assert found.exceptAll(expected).isEmpty()
    last = found.agg(F.max("window_start")).collect()[0][0]
    left = expected.exceptAll(found)
    assert left.where(F.col("window_start") < F.lit(last)).isEmpty()
    assert found.count() > 20
