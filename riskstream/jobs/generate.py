"""Publish generated transactions, velocity bursts included.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \
        --py-files riskstream.zip riskstream/jobs/generate.py 100000

``--live`` paces them by the interval setting until stopped.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from riskstream import session
from riskstream.config import GeneratorConfig, StreamConfig
from riskstream.operators.alerts import transaction_messages
from riskstream.operators.datagen import transactions
from riskstream.sources.streams import paced_ids
from riskstream.streaming.sinks import kafka_options


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    args.add_argument("count", type=int, nargs="?", help="lone transactions and bursts to make")
    args.add_argument("--live", action="store_true", help="one per interval, until stopped")
    args.add_argument("--seed", type=int, default=42)
    args.add_argument("--start", help="time of the first one; now if it is not given")
    args.add_argument("--sink", help="folder of payload lines instead of the topic")
    given = args.parse_args(argv)
    if given.live == (given.count is not None):
        args.error("give either a count or --live")

    config, pace = StreamConfig.from_env(), GeneratorConfig.from_env()
    spark = session.builder("riskstream-generate").getOrCreate()
    start = given.start or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    ids = paced_ids(spark, pace.interval) if given.live else spark.range(given.count)
    messages = transaction_messages(transactions(ids, given.seed, pace, start))

    if given.sink:
        messages, target = messages.select("value"), {"path": given.sink}
        file_format = "text"
    else:
        target, file_format = kafka_options(config, config.transaction_topic), "kafka"
    if not given.live:
        messages.write.format(file_format).options(**target).mode("append").save()
        return
    checkpoint = f"{config.checkpoint_dir}/generate"
    writer = messages.writeStream.queryName("generate").format(file_format).options(**target)
    writer.option("checkpointLocation", checkpoint).start().awaitTermination()


if __name__ == "__main__":
    main()
