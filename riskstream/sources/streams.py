"""Topics, and files that stand in for them, as streams of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskstream import schema
from riskstream.config import StreamConfig


def kafka_options(
    config: StreamConfig, topic: str, starting: str = "earliest", per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_stream(
    spark: SparkSession,
    config: StreamConfig,
    topic: str,
    starting: str = "earliest",
    per_trigger: int | None = None,
) -> DataFrame:
    """One topic; needs the Kafka connector on the class path."""
    options = kafka_options(config, topic, starting, per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession, path: str, file_format: str = "text", per_trigger: int | None = None
) -> DataFrame:
    """A folder of messages: ``text`` (a payload per line) or key/value files."""
    reader = spark.readStream.format(file_format)
    if file_format != "text":
        reader = reader.schema(schema.MESSAGE)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def paced_ids(spark: SparkSession, interval: float) -> DataFrame:
    """Ids for a generator, one per ``interval`` seconds (at least one a second)."""
    per_second = max(1, round(1 / interval))
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return ticks.selectExpr("value AS id")
