"""Turn the alert topic into readable text until stopped.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \
        --py-files riskstream.zip riskstream/jobs/watch_alerts.py OUT
"""

from __future__ import annotations

import argparse
from functools import partial

from riskstream import session
from riskstream.config import StreamConfig
from riskstream.sources.streams import file_stream, kafka_stream
from riskstream.streaming import alerts
from riskstream.streaming.sinks import files


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    args.add_argument("out", help="folder for the alert feed and the rejected payloads")
    args.add_argument("--source", help="folder of alert messages instead of the topic")
    args.add_argument("--starting", default="latest", choices=["earliest", "latest"])
    args.add_argument("--once", action="store_true", help="stop at the end of the input")
    given = args.parse_args(argv)

    config = StreamConfig.from_env()
    spark = session.builder("riskstream-alerts").getOrCreate()
    shared = partial(session.shared_path, spark)
    if given.source:
        messages = file_stream(spark, given.source, "parquet")
    else:
        messages = kafka_stream(spark, config, config.alerts_topic, given.starting)
    query = alerts.start(
        messages,
        feed=files(shared(f"{given.out}/feed"), "json"),
        rejected=files(shared(f"{given.out}/rejected"), "json"),
        checkpoint=shared(f"{config.checkpoint_dir}/alerts"),
        trigger={"availableNow": True} if given.once else None,
    )
    query.awaitTermination()


if __name__ == "__main__":
    main()
