"""Score the transaction topic until stopped.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \
        --py-files riskstream.zip riskstream/jobs/score.py

``--source DIR --sink DIR`` use folders of files in place of topics. All streams of the job
stop with the first that fails, and the job with its error.
"""

from __future__ import annotations

import argparse
from functools import partial

from riskstream import session
from riskstream.config import Policy, StreamConfig
from riskstream.operators import model
from riskstream.sources.streams import file_stream, kafka_stream
from riskstream.streaming import bursts, scoring, supervise
from riskstream.streaming.profiles import Profiles
from riskstream.streaming.sinks import files, kafka
from riskstream.streaming.stored import StoredIds

# Most of one batch unless told: a first start at the earliest offset takes many batches.
OFFSETS = 100_000
FILES = 100


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    args.add_argument("--source", help="folder of payload lines instead of the topic")
    args.add_argument("--sink", help="folder for messages instead of the topics")
    args.add_argument("--starting", default="earliest", choices=["earliest", "latest"])
    args.add_argument(
        "--per-trigger", type=int,
        help="most offsets (100,000 unless given) or files (100) per batch; the rest follows",
    )
    args.add_argument("--interval", help="time between batches, such as '30 seconds'")
    args.add_argument("--bursts", help="folder for users' windows of many transactions")
    args.add_argument(
        "--stored-ids", help="folder for an index of stored ids: redelivered messages add no row"
    )
    args.add_argument(
        "--committed", action="store_true",
        help="readers of stored scores see whole batches; jobs/compact.py rewrites small files",
    )
    args.add_argument("--profiles", help="folder for users' profiles, kept up to date")
    args.add_argument("--once", action="store_true", help="stop at the end of the input")
    given = args.parse_args(argv)

    config = StreamConfig.from_env()
    spark = session.builder("riskstream-score").getOrCreate()
    fitted = model.load(config.model_path)
    shared = partial(session.shared_path, spark)

    if given.source:
        messages = file_stream(spark, given.source, per_trigger=given.per_trigger or FILES)
    else:
        messages = kafka_stream(
            spark, config, config.transaction_topic, given.starting, given.per_trigger or OFFSETS
        )
    if given.sink:
        scored_topic = files(shared(f"{given.sink}/{config.scored_topic}"), "parquet")
        alerts_topic = files(shared(f"{given.sink}/{config.alerts_topic}"), "parquet")
    else:
        scored_topic = kafka(config, config.scored_topic)
        alerts_topic = kafka(config, config.alerts_topic)

    trigger = {"availableNow": True} if given.once else None
    if given.interval and not given.once:
        trigger = {"processingTime": given.interval}
    started = [scoring.start(
        messages,
        fitted,
        scoring.Outputs(
            table=shared(config.processed_path),
            scored_topic=scored_topic,
            alerts_topic=alerts_topic,
            cases=files(shared(config.fraud_path), "json"),
            dead_letter=files(shared(config.dead_letter_path), "json"),
            ids=StoredIds(shared(given.stored_ids)) if given.stored_ids else None,
            committed=given.committed,
            profiles=Profiles(spark, shared(given.profiles)) if given.profiles else None,
        ),
        checkpoint=shared(f"{config.checkpoint_dir}/scoring"),
        policy=Policy.from_env(),
        trigger=trigger,
    )]
    if given.bursts:
        started.append(
            bursts.start(
                messages, shared(given.bursts), shared(f"{config.checkpoint_dir}/bursts"),
                trigger=trigger,
            )
        )
    supervise.until_all_end(started)


if __name__ == "__main__":
    main()
