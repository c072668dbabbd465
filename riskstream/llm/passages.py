"""Near-duplicate passages across documents, by compact windows.

A text is its sequence of word shingles. Under one hash of shingles, a node of the
text's Cartesian tree is a position and the widest stretch in which it has the least
value: every subsequence of that compact window holding the position has the same
min-hash. Windows shorter than the shortest passage are of no use, and the others are
the runs of equal minima of a sliding window of that length, so arrays yield them
without building the tree: about 2n / length for n shingles.

1. Values that windows of two documents share are kept; the least id is the value's
   first document.
2. Every other window of a shared value is laid over the first document's, at the
   positions that have the value: an interval of either document. Where a common line or a family of variants
   makes the value's first window a poor match, a closer one is tried as well: the
   first of those that agree in the ``CONTEXT`` shingles from the position on, or up
   to it, which may lie elsewhere in the same first document. Any exact passage has
   room for one of the two.
3. Intervals of the same two documents that overlap, over all hashes, make a region,
   and every region is a candidate.
4. The region's full shingles confirm it: the longest stretches of shared shingles
   and what changed words, insertions and omissions leave between them, of at least
   the passage length and with the wanted Jaccard similarity.

Work and output are linear in the windows: a passage of thousands of documents is
compared with three documents at most.

Results by case: null and short texts have no passages; rows without an id take no
part; rows that repeat an id and its text are one document; of unlike texts under one id,
that of least hash is the document, and the others are documents that come after all of
other ids; extra columns are ignored; an empty table gives no row; a passage repeated only
within one document is not reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskstream.llm.common import WORD, Scratch, give_back, giving_back, mix, shingles

HASHES = 5  # at similarity 0.8 all five miss a passage 3 times in 10,000
SHINGLE = 5
PASSAGE = 50  # words
SEARCHED = 64  # runs up to which all stretches that may do are tried
# Shingles whose equality on one side of a position makes a closer group.
CONTEXT = (PASSAGE - SHINGLE + 1) // 2
TOGETHER = 1 << 17  # shingles worked on at once

_LOW = np.uint64((1 << 26) - 1)
_HIGH = ~_LOW
_SEEDS = mix(np.arange(HASHES, dtype=np.uint64) + np.uint64(1))
_WORD = re.compile(WORD)

# A window in three numbers, since rows of many columns fill the disk of a shuffle. place:
# the position, and how far the window reaches before and after it; sides: hashes of the
# contexts after and before, 0 where there is none.
WINDOW = "array<struct<value: long, place: long, sides: long>>"
REACH = 16  # bits; 31 are left for the position
LONGEST = 1 << 15  # starts that one window has; a longer one is several
PART = 1 << 24  # shingles of a text whose windows are found at once
PASSAGE_TYPE = (
    "array<struct<begin: int, end: int, first_begin: int, first_end: int, similarity: double>>"
)


def _sliding_least(values: np.ndarray, length: int) -> np.ndarray:
    """Least of each stretch of ``length``, by doubling."""
    width = 1
    while 2 * width <= length:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = length - width
    return np.minimum(values[: len(values) - rest], values[rest:])


def _contexts(items: np.ndarray, length: int) -> np.ndarray:
    """32-bit hashes of each ``length`` items in a row."""
    width, hashes = 1, items
    while 2 * width <= length:
        hashes = mix(hashes[:-width] + np.uint64(3) * hashes[width:])
        width *= 2
    rest = length - width
    hashes = mix(hashes[: len(hashes) - rest] + np.uint64(5) * hashes[rest:])
    return (hashes >> np.uint64(32)).astype(np.uint32)


def compact_windows(
    sequences: list[np.ndarray], length: int, most: int = PART
) -> tuple[np.ndarray, ...]:
    """Sequence, value, hash, position, left and right end of each compact window.

    A sequence of more than ``most`` items is worked on in parts, which overlap so that
    each stretch of ``length`` lies in one.
    """
    if max(map(len, sequences), default=0) <= most:
        return _compact_windows(sequences, length)
    found = []
    for i, sequence in enumerate(sequences):
        for start in range(0, max(len(sequence) - length + 1, 1), most):
            part = sequence[start : start + most + length - 1]
            _, value, hashed, *places = _compact_windows([part], length)
            found.append((np.full(len(value), i), value, hashed, *(p + start for p in places)))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _compact_windows(sequences: list[np.ndarray], length: int) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(s) for s in sequences])
    items = np.concatenate([*sequences, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(sequences)), sizes)
    first = np.concatenate([[0], np.cumsum(sizes)])
    found = []
    if len(items) >= length:
        starts = np.flatnonzero(owner[: len(items) - length + 1] == owner[length - 1 :])
        for i, seed in enumerate(_SEEDS):
            values = mix(items ^ seed)
            # The position in the low bits tells where the least value is.
            marked = (values & _HIGH) | np.arange(len(items), dtype=np.uint64)
            least = _sliding_least(marked, length)[starts]
            same = (least & _HIGH)[1:] == (least & _HIGH)[:-1]
            same &= owner[starts][1:] == owner[starts][:-1]
            same &= (starts - first[owner[starts]])[1:] % LONGEST != 0
            begins = np.flatnonzero(np.concatenate([[True], ~same])[: len(starts)])
            ends = np.append(begins[1:], len(starts)) - 1
            c = (least[begins] & _LOW).astype(np.int64)
            at = first[owner[starts[begins]]]
            found.append(
                (owner[starts[begins]], values[c].view(np.int64), np.full(len(c), i, np.int8),
                 c - at, starts[begins] - at, starts[ends[: len(begins)]] + length - 1 - at)
            )
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    parts = [np.concatenate(column) for column in zip(*found, strict=True)]
    order = np.argsort(parts[0], kind="stable")
    return tuple(part[order] for part in parts)


def _in_groups(batch: pa.Array) -> Iterator[list[np.ndarray]]:
    group, total = [], 0
    for value in batch:
        group.append(shingles(value.as_py(), SHINGLE))
        total += len(group[-1])
        if total >= TOGETHER:
            yield group
            group, total = [], 0
    if group:
        yield group


def _listed(kind: pa.DataType, owners: np.ndarray, count: int, values: pa.Array) -> pa.Array:
    offsets = np.searchsorted(owners, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values).cast(pa.list_(kind))


def window_values(text: Column, length: int) -> Column:
    """Min-hash values of a text's compact windows."""

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], pa.list_(pa.int64()))]
            for group in _in_groups(batch):
                owners, listed, *_ = compact_windows(group, length)
                parts.append(
                    _listed(pa.int64(), owners, len(group), pa.array(listed, pa.int64()))
                )
            yield pa.concat_arrays(parts)

    @F.arrow_udf("array<long>")
    def values(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return giving_back(found(batches))

    return values(text)


def _sides(group: list[np.ndarray], owners: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hashes of the contexts from each position on, and up to it, in one number."""
    sizes = np.array([len(s) for s in group])
    first = np.concatenate([[0], np.cumsum(sizes)])[owners]
    items = np.concatenate(group)
    hashes = _contexts(items, CONTEXT) if len(items) >= CONTEXT else np.zeros(1, np.uint32)
    sides = []
    for start in (c, c - CONTEXT + 1):
        lacking = (start < 0) | (start + CONTEXT > sizes[owners])
        at = np.clip(first + start, 0, len(hashes) - 1)
        sides.append(np.where(lacking, 0, np.maximum(hashes[at], 1)).astype(np.uint64))
    return (sides[0] << np.uint64(32) | sides[1]).view(np.int64)


def windows(text: Column, length: int) -> Column:
    """A text's compact windows."""
    kind = pa.struct([(n, pa.int64()) for n in ("value", "place", "sides")])

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], pa.list_(kind))]
            for group in _in_groups(batch):
                owners, values, _, c, left, right = compact_windows(group, length)
                place = (c << 2 * REACH) | (c - left << REACH) | (right - c)
                fields = [pa.array(x) for x in (values, place, _sides(group, owners, c))]
                rows = pa.StructArray.from_arrays(fields, fields=list(kind))
                parts.append(_listed(kind, owners, len(group), rows))
            yield pa.concat_arrays(parts)

    @F.arrow_udf(WINDOW)
    def listed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return giving_back(found(batches))

    return listed(text)


@F.arrow_udf(T.BinaryType())
def _slice(text: pa.Array, begin: pa.Array, end: pa.Array) -> pa.Array:
    """Shingles begin to end, inclusive; rows of one text come one after another."""
    found, last, sequence = [], None, None
    for t, b, e in zip(text, begin.to_pylist(), end.to_pylist(), strict=True):
        t = t.as_py()
        if sequence is None or t != last:
            last, sequence = t, shingles(t, SHINGLE)
        found.append(sequence[b : e + 1].tobytes())
    listed = pa.array(found, pa.binary())
    del found, last, sequence
    give_back()
    return listed


def _places(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether ``two`` has each shingle of ``one``, and where."""
    order = np.argsort(two, kind="stable")
    low = np.searchsorted(two, one, sorter=order)
    high = np.searchsorted(two, one, side="right", sorter=order)
    times, place = high - low, order[np.minimum(low, len(two) - 1)]
    several, single = np.flatnonzero(times > 1), np.flatnonzero(times == 1)
    if not len(several):
        return times > 0, place
    # Of several places the one on the diagonal of the nearest shingle that has one, or on
    # that of most of the shingles that have the fewest.
    if len(single):
        at = np.searchsorted(single, several)
        before, after = single[np.maximum(at - 1, 0)], single[np.minimum(at, len(single) - 1)]
        nearest = np.where(several - before <= after - several, before, after)
        shifts = place[nearest] - nearest
    else:
        few = several[np.unique(one[several], return_index=True)[1]]
        few = few[times[few] == times[few].min()]
        ways = np.concatenate([order[low[i] : high[i]] - i for i in few])
        ways, counts = np.unique(ways, return_counts=True)
        shifts = np.full(len(several), ways[counts.argmax()])
    for i, shift in zip(several.tolist(), shifts.tolist(), strict=True):
        places = order[low[i] : high[i]]
        k = int(np.searchsorted(places, i + shift))
        near = places[max(k - 1, 0) : k + 1]
        place[i] = near[np.abs(near - i - shift).argmin()]
    return times > 0, place


def _runs(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bounds in ``one`` and in ``two`` of the unbroken runs of shared shingles."""
    matched, place = _places(one, two)
    at = np.flatnonzero(matched)
    if not len(at):
        return (at,) * 4
    new = np.flatnonzero((np.diff(at) != 1) | (np.diff(place[at]) != 1))
    begin, end = at[np.concatenate([[0], new + 1])], at[np.append(new, len(at) - 1)]
    low, high = place[begin], place[end]
    # Fewer shingles than one word has are chance unless they lie between their neighbours.
    long = np.flatnonzero(end - begin + 1 >= SHINGLE)
    if len(long):
        number = np.arange(len(begin))
        k = np.searchsorted(long, number)
        is_long = end - begin + 1 >= SHINGLE
        after = np.where(k < len(long), low[long[np.minimum(k, len(long) - 1)]], len(two))
        before = np.where(k > 0, high[long[np.maximum(k - 1, 0)]], -1)
        kept = is_long | ((low > before) & (high < after))
        begin, end, low, high = begin[kept], end[kept], low[kept], high[kept]
    return begin, end, low, high


def matches(one: np.ndarray, two: np.ndarray, length: int, percent: int) -> list[tuple]:
    """Passages of ``one`` that ``two`` has: shingle bounds in both, and similarity.

    Of runs next to each other, a stretch may do if each shared shingle counts for it
    and each other one in it against it by their weights in the similarity. The longest
    that does on the full sets is a passage; what lies before and after is searched on.
    """
    begin, end, low, high = _runs(one, two)
    gains = (100 - percent) * (end - begin + 1)
    skipped, jumped = begin[1:] - end[:-1] - 1, low[1:] - high[:-1] - 1
    least = -(-length * percent // 100)  # shared shingles that a passage has

    def judged(i: int, j: int) -> tuple | None:
        """The stretch from run ``i`` to run ``j``."""
        b, e = int(begin[i]), int(end[j])
        l, h = int(low[i : j + 1].min()), int(high[i : j + 1].max())
        # A passage may begin or end with changed words.
        lacking = length - (e - b + 1)
        if lacking > 0:
            if len(one) < length:
                return None
            left = min(b, max(lacking // 2, lacking - (len(one) - 1 - e)))
            b, e = b - left, e + lacking - left
            l, h = max(l - left, 0), min(h + lacking - left, len(two) - 1)
        ours, theirs = np.unique(one[b : e + 1]), np.unique(two[l : h + 1])
        shared = len(np.intersect1d(ours, theirs, assume_unique=True))
        union = len(ours) + len(theirs) - shared
        if 100 * shared < percent * union:
            return None
        return b, e, l, h, shared / union

    def stretches(i: int, j: int, against: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each run the first from which a stretch up to it may do; longest ahead."""
        total = np.cumsum(gains[i : j + 1]) - np.concatenate([[0], np.cumsum(against[i:j])])
        lowest = np.minimum.accumulate(total - gains[i : j + 1])
        first = i + np.searchsorted(-lowest, -total)
        last = np.arange(i, j + 1)
        sizes = end[last] - begin[first] + 1
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] >= least]
        return first[order], last[order]

    def tried(i: int, j: int) -> Iterator[tuple[int, int]]:
        # Parts that change places count against none if the whole does all the same.
        first, last = stretches(i, j, percent * skipped)
        yield from list(zip(first.tolist(), last.tolist(), strict=True))[:1]
        first, last = stretches(i, j, percent * (skipped + np.abs(jumped)))
        if j - i >= SEARCHED:  # the longest from each first; its parts come after a split
            longest = np.sort(np.unique(first, return_index=True)[1])
            first, last = first[longest], last[longest]
        yield from zip(first.tolist(), last.tolist(), strict=True)

    found, todo = [], [(0, len(begin) - 1)]
    while todo:
        i, j = todo.pop()
        if i > j or end[j] - begin[i] + 1 < least:
            continue
        for first, last in tried(i, j):
            passage = judged(first, last)
            if passage:
                found.append(passage)
                todo += [(i, first - 1), (last + 1, j)]
                break
        else:
            if i < j:
                widest = i + int((skipped + np.abs(jumped))[i:j].argmax())
                todo += [(i, widest), (widest + 1, j)]
    return sorted(found)


def _confirmed(one: Column, two: Column, length: int, percent: int, size: int) -> Column:
    kind = pa.list_(
        pa.struct(
            [(n, pa.int32()) for n in ("begin", "end", "first_begin", "first_end")]
            + [("similarity", pa.float64())]
        )
    )

    @F.arrow_udf(PASSAGE_TYPE)
    def confirmed(ones: pa.Array, twos: pa.Array) -> pa.Array:
        rows = []
        for a, b in zip(ones, twos, strict=True):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            found = matches(a, b, length, percent) if len(a) and len(b) else []
            rows.append(
                [
                    {"begin": begin, "end": end + size, "first_begin": low,
                     "first_end": high + size, "similarity": similarity}
                    for begin, end, low, high, similarity in found
                ]
            )
        give_back()
        return pa.array(rows, kind)

    return confirmed(one, two)


# Documents from this number on stand for the further texts of an id that has several.
_FURTHER = 1 << 62


def _numbered(
    documents: DataFrame, key: str, text: str, scratch: Scratch
) -> tuple[DataFrame, DataFrame | None]:
    """Documents under numbers of their own, and the further texts of repeated ids."""
    docs = documents.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")
    ).where("doc_id is not null and text is not null")
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"))
    unlike = marked.groupBy("doc_id").agg(
        F.min("mark").alias("least"), F.max("mark").alias("most")
    ).where("least < most")
    unlike = scratch.keep(unlike.select("doc_id", "least"), "unlike")
    if unlike.isEmpty():
        return docs, None
    several = docs.withColumn("mark", F.xxhash64("text")).join(unlike, "doc_id")
    further = several.where("mark <> least").dropDuplicates(["doc_id", "mark"])
    further = scratch.keep(
        further.select(
            "doc_id", "mark", "text",
            (F.monotonically_increasing_id() + _FURTHER).alias("number"),
        ),
        "further",
    )
    first = docs.join(unlike, "doc_id", "left").where(
        "least is null or xxhash64(text) = least"
    ).select("doc_id", "text")
    texts = further.select(F.col("number").alias("doc_id"), "text")
    return first.unionByName(texts), further.drop("text")


def repeated_passages(
    documents: DataFrame, words: int = PASSAGE, percent: int = 80,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, begin, end, first_doc_id, first_begin, first_end, similarity).

    Words ``begin`` up to ``end`` of the document are nearly those of the first
    document, which has the lesser id.
    """
    scratch = Scratch(documents.sparkSession, "passages")
    docs, further = _numbered(documents, key, text, scratch)
    found = _repeated(docs, words, percent, scratch)
    if further is None:
        return found
    columns = found.columns
    for name in ("doc_id", "first_doc_id"):
        named = further.select(F.col("number").alias(name), F.col("doc_id").alias("own"))
        found = found.join(named, name, "left").withColumn(name, F.coalesce("own", name)).drop("own")
    return found.select(columns)


def _repeated(docs: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    length = words - SHINGLE + 1
    shared = (
        docs.select("doc_id", F.explode(window_values(F.col("text"), length)).alias("value"))
        .groupBy("value")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("value")
    )
    shared = scratch.keep(shared, "shared")
    found = docs.select("doc_id", F.explode(windows(F.col("text"), length)).alias("w"))
    found = scratch.keep(found.select("doc_id", "w.*").join(shared, "value"), "windows")

    scratch.drop("shared")

    def over_first(rows: DataFrame, *closer: str) -> DataFrame:
        """Windows beside the least document's first window of their group."""
        group = ["value", *closer]
        firsts = rows.groupBy(group).agg(F.min(F.struct("doc_id", "place", "sides")).alias("f"))
        return rows.join(firsts, group).select("value", "doc_id", "place", "sides", "f")

    sides = {
        "right": lambda name: F.shiftright(name, 32),
        "left": lambda name: F.col(name).bitwiseAND(0xFFFFFFFF),
    }
    # Windows that differ from the value's first window on one side try a closer one. So
    # do the first document's own, which may have the value at several places: all of a
    # closer group differ from the first window, or none.
    differs = {
        side: (of("sides") != 0) & (of("sides") != of("f.sides")) for side, of in sides.items()
    }
    other = F.col("doc_id") != F.col("f.doc_id")
    tried = over_first(found).where(other | differs["right"] | differs["left"])
    tried = scratch.keep(tried, "laid")
    scratch.drop("windows")
    laid = tried.where(other)
    for side, of in sides.items():
        rows = tried.where(differs[side]).withColumn(side, of("sides")).drop("f")
        laid = laid.union(over_first(rows, side).where(other))

    def position(name: str) -> Column:
        return F.shiftrightunsigned(name, 2 * REACH)

    def reach(name: str, shift: int) -> Column:
        return F.shiftrightunsigned(name, shift).bitwiseAND((1 << REACH) - 1)

    # Either window as far as it goes: words that only one of the two has may lie in it.
    laid = laid.select(
        "doc_id", F.col("f.doc_id").alias("first"),
        *[
            bound.cast("int").alias(f"{prefix}{side}")
            for prefix, name in (("", "place"), ("first_", "f.place"))
            for side, bound in (
                ("begin", position(name) - reach(name, REACH)),
                ("end", position(name) + reach(name, 0)),
            )
        ],
    )
    # Regions: intervals of two documents that overlap.
    of_two = Window.partitionBy("doc_id", "first").orderBy("begin", "end")
    reached = F.max("end").over(of_two.rowsBetween(Window.unboundedPreceding, -1))
    numbered = laid.withColumn(
        "new", (F.col("begin") > F.coalesce(reached, F.lit(-1))).cast("int")
    )
    numbered = numbered.withColumn("region", F.sum("new").over(of_two))
    bounds = {"begin": F.min, "end": F.max, "first_begin": F.min, "first_end": F.max}
    regions = (
        numbered.groupBy("doc_id", "first", "region")
        .agg(*[f(c).alias(c) for c, f in bounds.items()])
        .select(F.monotonically_increasing_id().alias("id"), "*")
    )
    regions = scratch.keep(regions, "regions")
    scratch.drop("laid")
    wanted = regions.select("id", F.lit(False).alias("of_first"), "doc_id", "begin", "end").union(
        regions.select("id", F.lit(True), "first", "first_begin", "first_end")
    )
    sides = docs.join(wanted, "doc_id").select(
        "id", "of_first", _slice("text", "begin", "end").alias("items")
    )
    both = sides.groupBy("id").agg(
        F.max(F.when(~F.col("of_first"), F.col("items"))).alias("one"),
        F.max(F.when(F.col("of_first"), F.col("items"))).alias("two"),
    )
    confirmed = both.select(
        "id", F.explode(_confirmed(F.col("one"), F.col("two"), length, percent, SHINGLE)).alias("p")
    )
    at = regions.select("id", "doc_id", "first", F.col("begin").alias("b"), "first_begin")
    spans = confirmed.join(at, "id").select(
        "doc_id", (F.col("b") + F.col("p.begin")).alias("begin"),
        (F.col("b") + F.col("p.end")).alias("end"), F.col("first").alias("first_doc_id"),
        (F.col("first_begin") + F.col("p.first_begin")).alias("first_begin"),
        (F.col("first_begin") + F.col("p.first_end")).alias("first_end"), "p.similarity",
    )
    # A text stands beside each of its regions, so its slices are taken in the small batches
    # of a kept table, not in those of whatever the caller does with the result.
    spans = scratch.keep(spans, "spans")
    scratch.drop("regions")
    return spans


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words ``begin`` up to ``end`` of each span."""
    bounds = [match.start() for match in _WORD.finditer(text)] + [len(text)]
    kept, at = [], 0
    for begin, end in sorted(spans):
        start = max(bounds[begin], at)
        kept.append(text[at:start])
        at = max(at, bounds[end])
    return "".join(kept) + text[at:]


@F.arrow_udf(T.StringType())
def _cut(text: pa.Array, spans: pa.Array) -> pa.Array:
    found = []
    for t, s in zip(text, spans, strict=True):
        listed = s.as_py()
        if listed and t.is_valid:
            t = pa.scalar(cut(t.as_py(), [(x["begin"], x["end"]) for x in listed]))
        found.append(t)
    kept = pa.array(found, pa.string())
    del found
    give_back()
    return kept


def without_repeats(
    documents: DataFrame, words: int = PASSAGE, percent: int = 80,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The documents without the passages that a document of lesser id has.

    All columns stay; ``n_chars``, if there, follows the text. A document of which
    nothing but white space is left goes; one without a repeated passage is untouched.
    """
    scratch = Scratch(documents.sparkSession, "passages")
    docs, further = _numbered(documents, key, text, scratch)
    found = _repeated(docs, words, percent, scratch)
    # A document's spans are no more than it has words.
    spans = found.groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_list(F.struct("begin", "end")).alias("__spans")
    )
    rows = documents.withColumn("__own", F.col(key).cast("long"))
    if further is not None:
        other = further.toDF("__doc", "__mark", "__number")
        same = (F.col("__own") == F.col("__doc")) & (F.xxhash64(text) == F.col("__mark"))
        rows = rows.join(other, same, "left").withColumn("__own", F.coalesce("__number", "__own"))
    rows = rows.join(spans, F.col("__own") == F.col("__id"), "left")
    repeats = F.col("__spans").isNotNull()
    # Other texts don't go through Python.
    cut_text = _cut(F.when(repeats, F.col(text)), F.col("__spans"))
    rows = rows.withColumn("__text", F.when(repeats, cut_text).otherwise(F.col(text)))
    rows = rows.where(~repeats | F.col("__text").rlike(WORD))
    columns = []
    for name in documents.columns:
        value = F.col(name)
        if name == text:
            value = F.col("__text")
        elif name == "n_chars":
            size = F.length("__text").cast(documents.schema[name].dataType)
            value = F.when(repeats, size).otherwise(value)
        columns.append(value.alias(name))
    return rows.select(columns)
