"""A trie of conversations by their first turns, totalled from the leaves up.

A node is a distinct sequence of first turns; its name is a 128-bit digest of the depth
and of two sums over the digests of the turns, each with its place. Sums of prefixes are
running sums, which are taken within blocks of a conversation, so that no conversation is
gathered however long.

Subtree totals are passed up by time-forward processing. Nodes are cut into pieces:
maximal connected parts whose numbers of conversations have one magnitude (to base 256).
At each depth of a piece there are fewer than 256 nodes, whatever share of all
conversations runs through it, so pieces are small and dealt evenly to tasks. Within a
task nodes are sorted by depth, deepest first; each sends its totals to its parent through
a priority queue in that same order, which adds up what goes to one parent and spills
sorted runs to an unnamed temporary file. The tops of the pieces send theirs to parents in
pieces of a higher magnitude, added up before they are shuffled, and these are processed
next: as many rounds as the number of all conversations has digits to base 256.

Results by case: a null role or text is empty; turns of one conversation go by turn (nulls
first), then role, then the digest of role and text, and repeated rows are turns of their
own; rows without a conv_id belong to no conversation; other columns are ignored; an empty
table has no nodes.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskstream.llm.common import WORD, Scratch, record_batches, rows_of

# Conversations that share their first turns come in groups of this many.
GROUP = 20
HEADS = 4
# Turns in a block of running sums.
BLOCK = 4096
# Bits of a digit of a node's number of conversations.
BITS = 8
# Parents a queue holds in memory.
QUEUE = 200_000
# Ids joined to one text before they are digested.
IDS = 4096

_SUM = "decimal(29,0)"


def _digest(*parts: Column) -> Column:
    """128 bits of a digest of columns, none of which holds a zero character but the last."""
    return F.substring(F.unhex(F.sha2(F.concat_ws("\0", *parts), 256)), 1, 16)


def _name(depth: Column, first: Column, second: Column) -> Column:
    return _digest(*[c.cast("string") for c in (depth, first, second)])


def _root() -> Column:
    zero = F.lit(0).cast(_SUM)
    return _name(F.lit(0).cast("long"), zero, zero)


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        _digest(F.length(role).cast("string"), role, text).alias("said"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    ).where("conv_id is not null")


def _placed(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Turns with their place in the conversation, from 0."""
    order = ["turn", "role", "said"]
    # A long conversation fills several ranges; its places go on from range to range.
    ranged = turns.repartitionByRange("conv_id", *order)
    kept = scratch.keep(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parts = kept.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = parts.select(
        "conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    return kept.join(before, ["conv_id", "part"]).select(
        "conv_id", "said", "words", (F.col("before") + within - 1).alias("place")
    )


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Conversations that share heads: their turns by depth, and the conversations.

    Conversation c begins with the first h turns of the first of its group of 20, where h
    is the checksum of its id modulo 4, and goes on with its own turns after its first h.
    """
    placed = scratch.keep(_placed(_turns(conversations), scratch), "placed")
    lengths = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    members = scratch.keep(
        lengths.select(
            "conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")
        ).join(bases, "base", "left").select(
            "conv_id", "h", "base",
            F.least("h", F.coalesce("base_n", F.lit(0))).alias("shared"),
        ),
        "members",
    )
    own = placed.join(members, "conv_id").where("place >= h").select(
        "conv_id", (F.col("shared") + F.col("place") - F.col("h") + 1).alias("depth"), "said",
        "words",
    )
    first = placed.where(F.col("place") < HEADS).withColumnRenamed("conv_id", "base")
    heads = first.join(members, "base").where("place < h").select(
        "conv_id", (F.col("place") + 1).alias("depth"), "said", "words"
    )
    turns = scratch.keep(own.unionByName(heads), "turns")
    return turns, members.select("conv_id")


def _prefixes(turns: DataFrame, block: int) -> DataFrame:
    """For each turn the node that ends with it, and that node's parent."""
    mixed = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), F.hex("said")), 256)
    parts = [F.conv(F.substring(mixed, at, 15), 16, 10).cast("decimal(19,0)") for at in (1, 16)]
    terms = turns.select(
        "conv_id", "depth", "words", F.floor((F.col("depth") - 1) / block).alias("block"),
        parts[0].alias("x"), parts[1].alias("y"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = terms.groupBy("conv_id", "block").agg(F.sum("x").alias("bx"), F.sum("y").alias("by"))
    before = sums.select(
        "conv_id", "block",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast(_SUM).alias(c) for c in ("bx", "by")],
    )
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    run = terms.join(before, ["conv_id", "block"]).select(
        "conv_id", "depth", "words", "x", "y",
        *[(F.col(f"b{c}") + F.sum(c).over(within)).cast(_SUM).alias(f"s{c}") for c in ("x", "y")],
    )
    past = [(F.col(f"s{c}") - F.col(c)).cast(_SUM) for c in ("x", "y")]
    return run.select(
        "conv_id", "depth", "words", _name(F.col("depth"), F.col("sx"), F.col("sy")).alias("node"),
        _name(F.col("depth") - 1, *past).alias("parent"),
    )


def _magnitude(count: Column, bits: int) -> Column:
    return F.floor((F.length(F.bin(count)) - 1) / bits).cast("int")


class Queue:
    """Totals on their way to parents, deepest parent first; sorted runs beyond ``limit``."""

    _RECORD = struct.Struct(">q16sqqq")

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.totals: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        self.heap: list[tuple[int, bytes]] = []
        self.runs: list[tuple] = []  # (next entry, number of the run, the rest of it)
        self.spills = 0

    def send(self, depth: int, node: bytes, totals: tuple[int, int, int]) -> None:
        target = (-depth, node)
        known = self.totals.get(target)
        if known is None:
            heappush(self.heap, target)
            self.totals[target] = totals
            if len(self.heap) > self.limit:
                self._spill()
        else:
            self.totals[target] = tuple(map(sum, zip(known, totals, strict=True)))

    def _read(self, file) -> Iterator[tuple]:
        size = self._RECORD.size
        file.seek(0)
        while data := file.read(1000 * size):
            for depth, node, *totals in self._RECORD.iter_unpack(data):
                yield (depth, node), tuple(totals)
        file.close()

    def _spill(self) -> None:
        # Without a name: gone with the task, however that ends.
        file = tempfile.TemporaryFile()
        for target in sorted(self.heap):
            file.write(self._RECORD.pack(*target, *self.totals[target]))
        self.heap, self.totals = [], {}
        run = self._read(file)
        self.spills += 1
        heappush(self.runs, (next(run), self.spills, run))

    def receive(self, depth: int, node: bytes) -> list[tuple[int, int, int]]:
        """All totals sent to a node; nodes ask in the queue's order."""
        target, found = (-depth, node), []
        if self.heap and self.heap[0] == target:
            heappop(self.heap)
            found.append(self.totals.pop(target))
        while self.runs and self.runs[0][0][0] == target:
            (_, totals), number, run = heappop(self.runs)
            found.append(totals)
            following = next(run, None)
            if following is not None:
                heappush(self.runs, (following, number, run))
        return found


_TOTALS = (
    "node binary, parent binary, top boolean, n_children long, n_leaves long, saved_tokens long"
)


def _forward(nodes: DataFrame, queue: int) -> DataFrame:
    """One magnitude's nodes with the totals of their subtrees.

    ``kids``, ``leaves`` and ``saved`` are what pieces of lower magnitude have sent.
    """
    schema = StructType.fromDDL(_TOTALS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def totals():
            waiting = Queue(queue)
            for node, parent, depth, piece, own, kids, leaves, saved in rows_of(batches):
                for received in waiting.receive(depth, node):
                    kids, leaves, saved = kids + received[0], leaves + received[1], saved + received[2]
                leaves, saved = leaves or 1, saved + own
                top = node == piece
                if not top:
                    waiting.send(depth - 1, parent, (1, leaves, saved))
                yield node, parent, top, kids, leaves, saved

        return record_batches(totals(), schema)

    columns = ("node", "parent", "depth", "piece", "own", "kids", "leaves", "saved")
    dealt = nodes.select(*columns).repartition("piece")
    return dealt.sortWithinPartitions(F.desc("depth"), "node").mapInArrow(task, schema)


def _ends(last: DataFrame, ids: int) -> DataFrame:
    """For each node the digest of the ids of the conversations that end there, ascending."""
    chunk = StructType.fromDDL("node binary, part int, k long, listed string")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def chunks():
            for node, own in groupby(rows_of(batches), key=lambda row: row[0]):
                k = 0
                while some := list(islice(own, ids)):
                    yield node, part, k, ",".join(str(conv) for _, conv in some)
                    k += 1

        return record_batches(chunks(), chunk)

    done = StructType.fromDDL("node binary, ends_sha256 string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests():
            for node, own in groupby(rows_of(batches), key=lambda row: row[0]):
                whole = hashlib.sha256()
                for i, (*_, listed) in enumerate(own):
                    whole.update(("," * (i > 0) + listed).encode())
                yield node, whole.hexdigest()

        return record_batches(digests(), done)

    # One node's ids spread over the ranges they fill; only joined texts come together.
    ranged = last.select("node", "conv_id").repartitionByRange("node", "conv_id")
    listed = ranged.sortWithinPartitions("node", "conv_id").mapInArrow(join, chunk)
    ordered = listed.repartition("node").sortWithinPartitions("node", "part", "k")
    return ordered.mapInArrow(digest, done)


def prefix_trie(
    turns: DataFrame, members: DataFrame, scratch: Scratch, block: int = BLOCK, bits: int = BITS,
    queue: int = QUEUE, ids: int = IDS,
) -> DataFrame:
    """The nodes of conversations given by ``turns`` (conv_id, depth, said, words).

    ``members`` has all conv_id, also of conversations without turns.
    """
    prefixes = scratch.keep(_prefixes(turns, block), "prefixes")
    grouped = prefixes.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.any_value("parent").alias("parent"), F.any_value("depth").alias("depth"),
        F.any_value("words").alias("words"),
    )
    top = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    top = top.where("n_convs > 0").select(
        _root().alias("node"), "conv_id", "n_convs", F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"),
    )
    size = _magnitude(F.col("n_convs"), bits)
    named = scratch.keep(
        grouped.unionByName(top).withColumn("magnitude", size)
        .withColumn("own", (F.col("n_convs") - 1) * F.col("words")),
        "named",
    )

    # A piece is named by its top: the first node of its magnitude on a conversation's way.
    large = named.where("magnitude > 0").select("node", "magnitude")
    sized = prefixes.join(large, "node", "left").withColumn(
        "magnitude", F.coalesce("magnitude", F.lit(0))
    )
    tops = sized.groupBy("conv_id", "magnitude").agg(F.min_by("node", "depth").alias("piece"))
    # The root is above every way, and the top of its own piece.
    most = named.agg(F.max("magnitude")).collect()[0][0]
    if most is not None:
        tops = tops.withColumn(
            "piece", F.when(F.col("magnitude") == most, _root()).otherwise(F.col("piece"))
        )
    pieces = named.join(tops, ["conv_id", "magnitude"], "left").withColumn(
        "piece", F.when(F.col("depth") == 0, F.col("node")).otherwise(F.col("piece"))
    )
    nodes = scratch.keep(pieces, "nodes")

    done: DataFrame | None = None
    for magnitude in range((most if most is not None else -1) + 1):
        here = nodes.where(F.col("magnitude") == magnitude)
        names = ("kids", "leaves", "saved")
        if done is None:
            sent = here.withColumns({name: F.lit(0).cast("long") for name in names})
        else:
            received = done.where("top").groupBy(F.col("parent").alias("node")).agg(
                F.count(F.lit(1)).alias("kids"), F.sum("n_leaves").alias("leaves"),
                F.sum("saved_tokens").alias("saved"),
            )
            sent = here.join(received, "node", "left").withColumns(
                {name: F.coalesce(name, F.lit(0)) for name in names}
            )
        totals = scratch.keep(_forward(sent, queue), f"totals{magnitude}")
        done = totals if done is None else done.unionByName(totals)

    last = members.join(
        prefixes.groupBy("conv_id").agg(F.max_by("node", "depth").alias("node")), "conv_id", "left"
    ).withColumn("node", F.coalesce("node", _root()))
    ends = _ends(last, ids)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    if done is None:
        longs = [F.lit(None).cast("long").alias(c) for c in columns[:-1]]
        return members.where("false").select(
            *longs, F.lit(None).cast("string").alias("ends_sha256")
        )
    nothing = F.sha2(F.lit(""), 256)
    return (
        nodes.drop("parent").join(done, "node").join(ends, "node", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
        .join(parents, "parent", "left").select(*columns)
    )
