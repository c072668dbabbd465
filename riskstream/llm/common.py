"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from riskstream.session import shared_folder

# A word: what stands between these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

# While a table is written: its shuffle files go at its end, since nothing reads them again
# and else they stay until the driver's garbage is collected; and Python workers are fed by
# small batches, since rows may hold whole texts and a batch stands in memory on both sides.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Scratch:
    """A new folder in the shared place, for tables that cut a lineage.

    Every executor can read it, so a lost executor loses nothing written there.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        """Write a frame and return the written table.

        The write runs under ``_WRITING``, and the session has its own settings again
        after it; meanwhile no other query should run in the same session.
        """
        conf = self.spark.conf
        before = {key: conf.get(key) for key in _WRITING}
        for key, value in _WRITING.items():
            conf.set(key, value)
        try:
            frame.write.mode("overwrite").parquet(self.path(name))
        finally:
            for key, value in before.items():
                conf.set(key, value)
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Give back a table that nothing reads any more."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of a task's batches, one at a time."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def record_batches(
    rows: Iterable[tuple], schema: StructType, size: int = 1000
) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most ``size``."""
    fields = list(to_arrow_schema(schema))
    rows = iter(rows)
    while some := list(islice(rows, size)):
        columns = zip(*some, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)],
            names=[f.name for f in fields],
        )


def give_back() -> None:
    """Return freed memory to the system: a worker lives on for the tasks of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def giving_back(batches: Iterator) -> Iterator:
    """What a task's function yields; the worker's freed memory is given back now and then."""
    try:
        for batch in batches:
            yield batch
            give_back()
    finally:
        give_back()


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers (the SplitMix64 finaliser)."""
    x = values.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[list(WHITE.encode())] = True
_LONG = 4096  # bytes; longer words are hashed one by one
_POWERS = np.cumprod(np.full(_LONG, 0x9E3779B97F4A7C15, np.uint64))
_STEP = 0xD1B54A32D192ED03


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, in order.

    A word's bytes are the coefficients of a polynomial modulo 2^64, which is then mixed.
    """
    codes = np.frombuffer(data, np.uint8)
    inked = ~_SPACE[codes]
    edges = np.flatnonzero(np.diff(inked, prepend=False, append=False))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    offsets = np.cumsum(lengths) - lengths
    used = codes[inked].astype(np.uint64) + np.uint64(1)
    within = np.arange(len(used)) - np.repeat(offsets, lengths)
    long = np.flatnonzero(lengths > _LONG)
    if len(long):
        within %= _LONG
    hashes = np.add.reduceat(_POWERS[within] * used, offsets)
    if len(long):
        import xxhash

        for i in long.tolist():
            word = data[starts[i] : starts[i] + lengths[i]]
            hashes[i] = xxhash.xxh64_intdigest(word)
    return mix(hashes)


def joined_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of each ``size`` words in a row."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    joined = np.zeros(n, np.uint64)
    for i in range(size):
        joined += hashes[i : n + i] * np.uint64(pow(_STEP, i + 1, 1 << 64))
    return mix(joined)


def shingles(text: str | None, size: int) -> np.ndarray:
    """64-bit hashes of a text's word shingles, in order."""
    return joined_hashes(word_hashes((text or "").encode()), size)
