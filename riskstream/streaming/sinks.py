"""Where a micro-batch goes.

A sink is a function of a frame and the batch it belongs to. File sinks
overwrite the folder of their batch, so a replayed batch leaves one copy; the
query's own id is part of the folder because a new checkpoint counts batches
from zero again. Topic sinks are at-least-once with stable keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskstream.config import StreamConfig


@dataclass(frozen=True)
class BatchRef:
    run: str
    batch_id: int

    def folder(self, root: str) -> str:
        return f"{root}/run={self.run}/batch_id={self.batch_id}"


Sink = Callable[[DataFrame, BatchRef], None]


@dataclass(frozen=True)
class Delivery:
    """What became of a batch: rows scored, and rows that each output took without an error.

    ``failed`` names the output that raised; those after it were not tried.
    """

    batch: BatchRef
    scored: int
    delivered: dict[str, int]
    failed: str | None = None


def files(root: str, file_format: str) -> Sink:
    """Parquet for tables, JSON lines for cases, either for stand-in topics."""

    def write(frame: DataFrame, batch: BatchRef) -> None:
        frame.write.format(file_format).mode("overwrite").save(batch.folder(root))

    return write


def kafka_options(config: StreamConfig, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": config.bootstrap_servers, "topic": topic}


def kafka(config: StreamConfig, topic: str) -> Sink:
    """A key/value frame to a topic; needs the Kafka connector."""

    def write(frame: DataFrame, batch: BatchRef) -> None:
        frame.write.format("kafka").options(**kafka_options(config, topic)).save()

    return write
