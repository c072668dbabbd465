"""Repair of conversations whose turns are blank, repeated, cut off or out of turn.

``repair_conversations`` finds for each conversation the cheapest edits that leave roles
``(s?(ua)+)?`` and, of equally cheap ones, the least audit (see ``edit_lattice``).

Conversations are read from sorted partitions, one at a time. Those of more than
``LONG_ROWS`` turns or ``LONG_BYTES`` of text are not gathered: their turns are sorted
over many partitions and cut into blocks; each block is searched for every pair of
grammar states it may be entered and left in; a pass over a conversation's blocks, which
carry no text, picks the pairs; and each block is then repaired by itself. Only the
digest of a whole repaired conversation is sequential: it streams the finished blocks.

Results by case: a null role or text counts as one space; rows without a conv_id
are one conversation; turns go by turn (nulls first), then role, then text; a role that is
empty, or whose first letter is not s, u or a, can't be kept; a conversation of which no
row is left has zeros, an empty audit and the digest of the empty text; gaps that exceed
64 bits are null; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskstream.llm.common import WHITE, Scratch, record_batches, rows_of
from riskstream.llm.edit_lattice import ENDS, START, Turn, repair, repaired

LONG_ROWS = 1024
LONG_BYTES = 16 << 20
# A block of a long conversation.
BLOCK_ROWS = 1024
BLOCK_BYTES = 4 << 20

LEGAL = ("su", "ua", "au")
ORDER = ["conv_id", "turn", "role", "text"]
_LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = ", ".join(f"{c} long" for c in _LONGS) + ", audit string, repaired_sha256 string"
_PAIRS = [(a, b) for a in range(4) for b in range(4)]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the damage that the checksum of conversation and turn deals them.

    A dropped row stays as a mark that its conversation exists.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    cut = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        cut.otherwise(text).alias("text"), (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("copy"),
    ).drop("copy")


def undamaged(conversations: DataFrame) -> DataFrame:
    """Rows as they are, for real conversations."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), *text, F.lit(False).alias("dropped")
    )


def _schema(rows: DataFrame, columns: str) -> StructType:
    """A result's columns after the conversation's id, whatever its type."""
    return StructType([rows.schema["conv_id"], *StructType.fromDDL(columns)])


def _look(role: str, text: str, repeated: bool) -> tuple[Turn, str | None]:
    """A turn as the lattice sees it, and its first fault."""
    said = text.rstrip(WHITE)
    if not said:
        return Turn(role[:1], True, False), "blank"
    if repeated:
        return Turn(role[:1], True, False), "duplicate"
    open_ended = said[-1] not in ".!?"
    return Turn(role[:1], False, open_ended), "truncated" if open_ended else None


class _Counts:
    """What is counted over a run of turns in order; runs can be joined."""

    def __init__(self) -> None:
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.least = self.most = self.first_initial = self.last_initial = None

    def add(self, turn: int | None, initial: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        self._pair(initial)
        if self.first_initial is None:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn

    def _pair(self, initial: str) -> None:
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in LEGAL

    def join(self, blank, duplicate, truncated, illegal, turns, least, most, first, last) -> None:
        """Add the counts of the run that follows."""
        for name, n in zip(self.faults, (blank, duplicate, truncated), strict=True):
            self.faults[name] += n
        self._pair(first)
        self.illegal, self.last_initial = self.illegal + illegal, last
        if least is not None:
            self.turns += turns - (least == self.most)
            self.least, self.most = least if self.least is None else self.least, most

    def run(self) -> tuple:
        return (
            *self.faults.values(), self.illegal, self.turns, self.least, self.most,
            self.first_initial, self.last_initial,
        )

    def totals(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return gaps if gaps < 1 << 63 else None, *self.faults.values(), self.illegal


_RUN = (
    "blank long, duplicate long, truncated long, illegal long, turns long, least long, "
    "most long, first string, last string"
)


def _lines(rows: Iterable[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in rows).encode()


def _whole(rows: Iterable[tuple]) -> tuple:
    """The result of one conversation that is not long."""
    counts, seen, turns, texts = _Counts(), set(), [], []
    for turn, role, text, dropped in rows:
        if dropped:
            continue
        look, fault = _look(role, text, (role, text) in seen)
        seen.add((role, text))
        counts.add(turn, look.initial, fault)
        turns.append(look)
        texts.append((role, text))
    cost, audit = repair(turns)
    digest = hashlib.sha256(_lines(repaired(turns, texts, audit))).hexdigest()
    return *counts.totals(), cost, audit, digest


def _short(rows: DataFrame) -> DataFrame:
    schema = _schema(rows, _RESULT)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            (conv, *_whole(row[1:] for row in own))
            for conv, own in groupby(rows_of(batches), key=lambda row: row[0])
        )
        return record_batches(found, schema)

    return rows.repartition("conv_id").sortWithinPartitions(*ORDER).mapInArrow(task, schema)


# Long conversations


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """Long conversations as blocks of turns, with what each block may cost."""
    # The first turn of each role and text of a conversation; nulls come first.
    digest = F.sha2(F.concat_ws("\0", F.length("role").cast("string"), "role", "text"), 256)
    marked = rows.withColumn("digest", digest)
    place = F.struct(F.col("turn").isNotNull().alias("timed"), "turn")
    firsts = marked.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min(place).alias("earliest")
    )
    seen = marked.join(
        firsts, _same(F.col("conv_id"), F.col("c")) & (F.col("digest") == F.col("d"))
    ).select(*ORDER, (place > F.col("earliest")).alias("seen"), "dropped")
    # Ranges of turns: a conversation spreads over as many partitions as it fills.
    ordered = seen.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    schema = _schema(
        rows,
        f"part int, k int, {_RUN}, pairs array<struct<cost: long, audit: string>>, "
        "looks array<struct<initial: string, faulty: boolean, truncated: boolean>>, "
        "roles array<string>, texts array<string>",
    )

    def cut(own: Iterator[tuple]) -> Iterator[list[tuple]]:
        block, size = [], 0
        for row in own:
            block.append(row)
            size += len(row[3])
            if len(block) >= block_rows or size > BLOCK_BYTES:
                yield block
                block, size = [], 0
        if block:
            yield block

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def blocks():
            number = 0
            for conv, own in groupby(rows_of(batches), key=lambda row: row[0]):
                before = None
                for block in cut(row for row in own if not row[5]):
                    counts, turns = _Counts(), []
                    for _, turn, role, text, seen, _ in block:
                        # Rows alike lie side by side, and in one partition.
                        look, fault = _look(role, text, seen or before == (turn, role, text))
                        before = (turn, role, text)
                        counts.add(turn, look.initial, fault)
                        turns.append(look)
                    costs = [repair(turns, a, (b,), tail=False) for a, b in _PAIRS]
                    yield (
                        conv, part, number, *counts.run(),
                        [c and {"cost": c[0], "audit": c[1]} for c in costs],
                        [t._asdict() for t in turns], [r[2] for r in block], [r[3] for r in block],
                    )
                    number += 1

        return record_batches(blocks(), schema, 1)

    return ordered.mapInArrow(task, schema)


def _choose(blocks: list[tuple]) -> tuple[int, list[int], str]:
    """The least cost over all blocks, the state before each block, and the edits at the end.

    ``blocks`` hold for each pair of states a cost and the rank of its audit among the
    block's. No audit of a block begins another, so the first block in which two paths
    differ says which audit is less.
    """
    labels = {START: (0, 0)}  # state: cost, place among the live paths by audit
    trail = []
    for pairs in blocks:
        found: dict[int, tuple] = {}
        for (a, b), pair in zip(_PAIRS, pairs, strict=True):
            if pair is None or a not in labels:
                continue
            cost, place = labels[a]
            label = (cost + pair[0], place, pair[1], a)
            if b not in found or label < found[b]:
                found[b] = label
        order = sorted(found, key=lambda b: found[b][1:3])
        labels = {b: (found[b][0], order.index(b)) for b in found}
        trail.append({b: found[b][3] for b in found})
    ends = []
    for state, (cost, place) in labels.items():
        more, audit = repair([], state)
        ends.append((cost + more, place, audit, state))
    cost, _, tail, state = min(ends)
    passed = [state]
    for came in reversed(trail):
        passed.append(came[passed[-1]])
    return cost, passed[::-1], tail


def _chosen(blocks: DataFrame) -> DataFrame:
    """For each block the states it is entered and left in; totals stand in the first block."""
    totals = ", ".join(f"{c} long" for c in _LONGS)
    schema = StructType.fromDDL(f"part int, k int, a int, b int, ends string, {totals}")
    # Ranks in place of audits: a conversation's blocks then take a few bytes each.
    audits = F.array_sort(F.array_distinct(F.filter("pairs.audit", lambda x: x.isNotNull())))
    ranked = F.transform(
        "pairs",
        lambda p: F.when(
            p.isNotNull(), F.array(p["cost"], F.array_position(audits, p["audit"]).cast("long"))
        ),
    )
    run = [c.split()[0] for c in _RUN.split(", ")]
    small = blocks.select("conv_id", "part", "k", *run, ranked.alias("ranked"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for _, own in groupby(rows_of(batches), key=lambda row: row[0]):
                counts, places, tables = _Counts(), [], []
                for _, part, k, *run_, ranked_ in own:
                    counts.join(*run_)
                    places.append((part, k))
                    tables.append(ranked_)
                cost, passed, tail = _choose(tables)
                found = (*counts.totals(), cost)
                for i, (part, k) in enumerate(places):
                    ends = tail if i == len(places) - 1 else ""
                    yield (
                        part, k, passed[i], passed[i + 1], ends,
                        *(found if i == 0 else [None] * len(found)),
                    )

        return record_batches(rows(), schema)

    sorted_ = small.repartition("conv_id").sortWithinPartitions("conv_id", "part", "k")
    return sorted_.mapInArrow(task, schema)


def _long(rows: DataFrame, scratch: Scratch, block_rows: int) -> DataFrame:
    blocks = scratch.keep(_blocks(rows, block_rows), "blocks")
    # One small row for each block: as unique a key as a block has.
    chosen = scratch.keep(_chosen(blocks), "chosen")
    heavy = blocks.select("conv_id", "part", "k", "pairs", "looks", "roles", "texts")
    audit = F.col("pairs")[F.col("a") * 4 + F.col("b")]["audit"]
    picked = heavy.join(chosen, ["part", "k"]).select(
        "conv_id", "part", "k", *_LONGS, "a", "ends", audit.alias("audit"), "looks", "roles", "texts"
    )
    totals = ", ".join(f"{c} long" for c in _LONGS)
    done = _schema(rows, f"part int, k int, {totals}, audit string, lines binary")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def applied():
            for *kept, a, ends, audit, looks, roles, texts in rows_of(batches):
                turns = [Turn(**look) for look in looks]
                both = list(zip(roles, texts, strict=True))
                lines = repaired(turns, both, audit + ends, a)
                yield (*kept, audit + ends, _lines(lines) if lines else None)

        return record_batches(applied(), done, 1)

    schema = _schema(rows, _RESULT)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined():
            for conv, own in groupby(rows_of(batches), key=lambda row: row[0]):
                found, audits, digest, begun = None, [], hashlib.sha256(), False
                for row in own:
                    found = found or row[3:-2]  # of the first block
                    audits.append(row[-2])
                    if row[-1] is not None:
                        digest.update(b"\n" * begun + row[-1])
                        begun = True
                yield (conv, *found, "".join(audits), digest.hexdigest())

        return record_batches(joined(), schema)

    ordered = picked.mapInArrow(apply, done).repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "part", "k").mapInArrow(join, schema)


def repair_conversations(
    rows: DataFrame, scratch: Scratch, long_rows: int = LONG_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row for each conversation of ``damaged`` or ``undamaged`` rows."""
    sizes = rows.groupBy("conv_id").agg(
        F.count_if(~F.col("dropped")).alias("n"), F.sum(F.octet_length("text")).alias("bytes")
    )
    long = sizes.where((F.col("n") > long_rows) | (F.col("bytes") > LONG_BYTES))
    ids = scratch.keep(long.where("n > 0").select(F.col("conv_id").alias("long_id")), "long")
    if ids.isEmpty():
        return _short(rows)
    same = _same(F.col("conv_id"), F.col("long_id"))
    short = _short(rows.join(ids, same, "left_anti"))
    kept = rows.join(ids, same, "left_semi").where(~F.col("dropped"))
    return short.unionByName(_long(kept, scratch, block_rows))
