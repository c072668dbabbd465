"""Time the headline queries; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

import pyarrow.parquet as pq

from riskstream import session
from riskstream.operators import model
from riskstream.plans import queries

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = [
    "tx_decode",
    "quarantine",
    "forest_probability",
    "scored_full",
    "fraud_alerts",
    "alert_text",
    "batch_summary",
    "top_risk",
    "relabel",
    "auc",
    "fit_and_judge",
    "velocity_tumbling",
    "velocity_sliding",
    "velocity_session",
    "velocity_trailing",
    "burst_flag",
    "tx_dedup",
    "stream_scored",
]


def timed(spark, name: str) -> float:
    """Build the query and compute every row of it, without keeping any."""
    start = time.perf_counter()
    frame = queries.registry()[name](spark, FOLDER)
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        session.builder("riskstream-bench")
        .master(f"local[{CPUS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="riskstream-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    model.pinned(spark)
    for name in HEADLINE:  # warm-up: compiled code and file caches
        timed(spark, name)
    seconds = {
        name: round(statistics.median(timed(spark, name) for _ in range(REPEATS)), 4)
        for name in HEADLINE
    }
    events = pq.read_metadata(f"{FOLDER}/events.parquet").num_rows
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "events": events,
                "scored_rows_per_sec": round(events / seconds["scored_full"]),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
