"""Best-fit packing with a lower bound that certifies each partition's bins.

Documents become token ids; longer ones are cut into pieces of the capacity, of
which the first may be shorter. Each partition packs its pieces by best-fit
decreasing. Dual feasible functions bound from below the bins any packing of
those pieces needs. A partition that meets its bound is proven best and final.
One that does not keeps its full bins and gives the others away: whole bins of
all such partitions are dealt anew, unpacked, and packed again by best-fit
decreasing; a group that does not save a bin keeps the bins it was dealt. So the
number of bins never grows, and no task holds more than about ``PIECES`` pieces.

Results by case: a null or empty text is the one id that ends a document; repeated
rows are documents of their own; a null id stays null; extra columns are ignored;
an empty table gives no sequence.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import Scratch, giving_back

CAPACITY = 2048
END = 0  # the id that ends each document
# Pieces that one task packs.
PIECES = 50_000
ROUNDS = 4

PIECE = "array<struct<start: long, length: long, ids_crc32: long, ids: binary>>"
PACKED = (
    "doc_id {key}, piece int, start long, length long, ids_crc32 long, ids binary, "
    "sequence_id long, offset long, final boolean"
)

# How the byte-level tokenizers split a text before any merge (a fixed value).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


class _Encoder:
    """Ids of whole texts, as little-endian 32-bit numbers, by the tokenizer at ``path``.

    A byte-level vocabulary in order of its merges is also a table of ranks; the
    rank form gives the same ids several times faster.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        # The alphabet stands for the 256 bytes: printable ones for themselves, the rest
        # in order from 256 on.
        alphabet = sorted(ByteLevel.alphabet())
        byte = {c: ord(c) for c in alphabet if ord(c) < 256}
        rest = (b for b in range(256) if b not in byte.values())
        byte |= {c: next(rest) for c in alphabet if ord(c) >= 256}
        ranks = {
            bytes(map(byte.__getitem__, token)): i
            for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items()
        }
        self.ranked = tiktoken.Encoding(
            path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def encode(self, text: str) -> bytes:
        try:
            return self.ranked.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        except (ValueError, RuntimeError):  # its patterns give up on some very long runs
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()


@cache
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def cut(ids: bytes, capacity: int, keep: bool) -> list[tuple]:
    """Pieces of a document's ids; only the first may be shorter than the capacity."""
    n = len(ids) // 4
    first = n % capacity or min(n, capacity)
    bounds = [0, *range(first, n + 1, capacity)]
    pieces = []
    for start, stop in zip(bounds, bounds[1:], strict=False):
        part = ids[4 * start : 4 * stop]
        pieces.append((start, stop - start, zlib.crc32(part), part if keep else None))
    return pieces


def token_pieces(text: Column, tokenizer: str, capacity: int, keep_ids: bool) -> Column:
    """The pieces of a text column under the tokenizer file ``tokenizer``."""
    end = struct.pack("<I", END)

    def cut_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(tokenizer)
        kind = pa.list_(
            pa.struct(
                [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                 ("ids", pa.binary())]
            )
        )
        for batch in batches:
            found = [
                cut(encoder.encode(value.as_py() or "") + end, capacity, keep_ids)
                for value in batch
            ]
            starts = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = [piece for pieces in found for piece in pieces]
            columns = list(zip(*flat, strict=True)) or [(), (), (), ()]
            parts = [pa.array(c, f.type) for c, f in zip(columns, kind.value_type, strict=True)]
            yield pa.ListArray.from_arrays(
                pa.array(starts), pa.StructArray.from_arrays(parts, fields=list(kind.value_type))
            )

    @F.arrow_udf(PIECE)
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return giving_back(cut_all(batches))

    return pieces(text)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: the best of two families of dual feasible functions."""
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    # Above capacity - a a piece counts as a whole bin, below a as nothing.
    for a in sizes[sizes <= capacity // 2]:
        whole = int(counts[sizes > capacity - a].sum())
        part = (sizes >= a) & (sizes <= capacity - a)
        best = max(best, whole + -(-int((sizes[part] * counts[part]).sum()) // capacity))
    # Sizes rounded down to multiples of 1/k, by (k + 1)-ths; exact multiples stay.
    for k in range(1, 100):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each piece its bin and place there, and the number of bins."""
    order = np.argsort(-lengths, kind="stable")
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by room left
    open_rooms, used = 0, 0  # bit r: some bin has room r
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = rooms[room].pop()
            if not rooms[room]:
                open_rooms ^= 1 << room
        else:
            room, number, used = capacity, used, used + 1
        bins[i], places[i] = number, capacity - room
        if room > size:
            rooms[room - size].append(number)
            open_rooms |= 1 << (room - size)
    return bins, places, used


def _packer(capacity: int, round_number: int, last: bool):
    """Pack one partition; ``sequence_id`` holds the bins it was dealt, if any."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [batch for batch in batches if len(batch)]
        if not frames:
            return
        rows = pd.concat(frames, ignore_index=True)
        lengths = rows["length"].to_numpy(np.int64)
        bins, places, used = best_fit_decreasing(lengths, capacity)
        base = (round_number << 56) + (TaskContext.get().partitionId() << 32)
        if round_number and used >= rows["sequence_id"].nunique():
            bins, used = pd.factorize(rows["sequence_id"])[0], rows["sequence_id"].nunique()
        else:
            rows["sequence_id"], rows["offset"] = base + bins, places
        filled = np.bincount(bins, lengths, used)
        proven = last or used == lower_bound(lengths, capacity)
        rows["final"] = True if proven else (filled == capacity)[bins]
        yield rows

    return pack


def pack(pieces: DataFrame, scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with the sequence each lies in and its place there."""
    schema = PACKED.format(key=pieces.schema["doc_id"].dataType.simpleString())
    rows, done = pieces, []
    for number in range(ROUNDS):
        count = rows.count()
        if not count:
            break
        parts = -(-count // PIECES)
        last = number == ROUNDS - 1
        # First in turn, whatever the keys; then whole bins, of which none is large.
        dealt = rows.repartition(parts, "sequence_id") if number else rows.repartition(parts)
        packed = scratch.keep(
            dealt.mapInPandas(_packer(capacity, number, last), schema), f"round{number}"
        )
        done.append(packed.where("final"))
        rows = packed.where("not final")
    result = pieces.where("false") if not done else done[0]
    for other in done[1:]:
        result = result.unionByName(other)
    return result.drop("final")


def pieces_of(
    documents: DataFrame, tokenizer: str, scratch: Scratch, capacity: int = CAPACITY,
    keep_ids: bool = False, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row for each piece of each document, not yet packed; tokenized once."""
    found = documents.select(
        F.col(key).alias("doc_id"),
        F.posexplode(token_pieces(F.col(text), tokenizer, capacity, keep_ids)).alias("piece", "p"),
    )
    none = [F.lit(None).cast("long").alias(c) for c in ("sequence_id", "offset")]
    none.append(F.lit(False).alias("final"))
    return scratch.keep(found.select("doc_id", "piece", "p.*", *none), "pieces")


def packed(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """Documents as pieces packed into sequences; ``ids`` only if asked for."""
    scratch = Scratch(documents.sparkSession, "packing")
    result = pack(pieces_of(documents, tokenizer, scratch, capacity, keep_ids), scratch, capacity)
    return result if keep_ids else result.drop("ids")
