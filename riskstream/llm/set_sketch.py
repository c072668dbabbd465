"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct word shingles. Each shingle throws
exponentially spaced points at random registers; a register keeps the least, in
steps of a factor ``BASE``, in one byte. Registers of a union are the larger of
both, and two sets agree in a register about as often as their Jaccard similarity.

1. Documents of the same set are one class, and go on as one node.
2. Bands of ``BAND`` registers put a class in ``BANDS`` buckets. At similarity 0.8 a
   pair misses every bucket with probability 5e-9; unrelated sets, which agree in a
   register with probability 0.023, meet with probability 8e-12.
3. In a bucket of several classes one, drawn by the bucket, is the centre. A class is
   compared with the centre it meets most often, so a bucket costs no more than its
   size, and most of a large group is one component after that.
4. Where a bucket still holds several components there may be links left. Its classes
   are in the family of the least of these; the family's commonest centre is its base,
   and each class is written as what it and the base don't share. Classes near the base
   are linked to it. Then the class nearest to the family's middle becomes the base, and
   those near it are linked too.
   Of a linked pair the two differences share one of their rarest items. So each class is
   first compared with one that has many of its items, and pairs of what still lies apart
   come from an exact prefix join on those items: what a family has in common, which would
   pair all its members, cancels out.
5. A pair is first estimated from both registers at once by maximum likelihood over
   the known sizes; one more than six deviations below the threshold goes. The rest
   is confirmed on the full sets of 64-bit shingle hashes.

Results by case: a text without words, or null, is an empty set, linked with nothing;
one with fewer words than a shingle is one shingle of them all; repeated rows have one
class; a row without an id takes part, and is kept only if no row of its component has
an id; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskstream.llm.common import Scratch, give_back, giving_back, joined_hashes, mix, word_hashes
from riskstream.llm.graph import components

REGISTERS = 768
BASE, RATE, TOP = 1.1, 20.0, 255
BAND = 8
BANDS = REGISTERS // BAND
TOGETHER = 1 << 14  # shingles sketched at once; larger sets are sketched in parts

SKETCH = "struct<n_shingles: long, key1: long, key2: long, registers: binary>"


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; A-Z are lower-cased."""
    import xxhash

    lowered = (text or "").encode().lower()
    hashes = word_hashes(lowered)
    if 0 < len(hashes) < words:
        whole = b" ".join(lowered.split())
        return np.array([xxhash.xxh64_intdigest(whole, len(hashes))], np.uint64)
    return np.unique(joined_hashes(hashes, words))


def _levels(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers for each of a few sets."""
    places = np.repeat(np.arange(len(sets)) * REGISTERS, [len(s) for s in sets])
    items = np.concatenate([*sets, np.empty(0, np.uint64)])
    least = np.full(len(sets) * REGISTERS, np.inf)
    at, drawn = np.zeros(len(items)), 0
    while len(items):
        # As many points of each item at once as make the arrays worth their overhead.
        points = max(1, min(64, 8192 // len(items)))
        steps = (np.arange(drawn, drawn + points, dtype=np.uint64) + np.uint64(1)) * np.uint64(
            0xD1B54A32D192ED03
        )
        noise = mix(items[:, None] ^ mix(steps)[None, :])
        # The low 40 bits say when a point comes, the high 24 at which register.
        uniform = ((noise & np.uint64((1 << 40) - 1)).astype(float) + 1) * 2.0**-40
        register = (noise >> np.uint64(40)) * np.uint64(REGISTERS) >> np.uint64(24)
        where = places[:, None] + register.astype(np.int64)
        times = at[:, None] + np.cumsum(-np.log(uniform), axis=1) / (RATE * REGISTERS)
        np.minimum.at(least, where.ravel(), times.ravel())
        limit = least.reshape(-1, REGISTERS).max(axis=1)
        going = times[:, -1] < limit[places // REGISTERS]
        items, places, at = items[going], places[going], times[going, -1]
        drawn += points
    levels = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(levels, 0, TOP).astype(np.uint8).reshape(-1, REGISTERS)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers for each set; those of a large one are merged from its parts."""
    rows, group, total = [np.empty((0, REGISTERS), np.uint8)], [], 0
    for items in [*sets, None]:
        if group and (items is None or total + len(items) > TOGETHER):
            rows.append(_levels(group))
            group, total = [], 0
        if items is not None and len(items) > TOGETHER:
            parts = (_levels([items[i : i + TOGETHER]]) for i in range(0, len(items), TOGETHER))
            rows.append(reduce(np.maximum, parts))
        elif items is not None:
            group.append(items)
            total += len(items)
    return np.concatenate(rows)


def _keys(sets: list[np.ndarray]) -> list[pa.Array]:
    """Halves of a 128-bit digest of each set; an empty set has none."""
    import xxhash

    digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
    return [
        pa.array(
            [d and int.from_bytes(d[i : i + 8], "little", signed=True) for d in digests],
            pa.int64(),
        )
        for i in (0, 8)
    ]


def _in_groups(batch: pa.Array, words: int) -> Iterator[list[np.ndarray]]:
    """The shingle sets of a batch of texts, as many at once as have ``TOGETHER`` shingles."""
    group, total = [], 0
    for value in batch:
        group.append(shingle_set(value.as_py(), words))
        total += len(group[-1])
        if total >= TOGETHER:
            yield group
            group, total = [], 0
    if group:
        yield group


def sketch(text: Column, words: int) -> Column:
    """Set size, digest of the set, and registers of a text column."""

    fields = {"n_shingles": pa.int64(), "key1": pa.int64(), "key2": pa.int64(),
              "registers": pa.binary()}

    def parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [
                pa.StructArray.from_arrays(
                    [pa.array([], kind) for kind in fields.values()], names=list(fields)
                )
            ]
            for sets in _in_groups(batch, words):
                registers = [
                    row.tobytes() if len(s) else None
                    for s, row in zip(sets, sketches(sets), strict=True)
                ]
                columns = [pa.array(map(len, sets), pa.int64()), *_keys(sets),
                           pa.array(registers, pa.binary())]
                found.append(pa.StructArray.from_arrays(columns, names=list(fields)))
            yield pa.concat_arrays(found)

    @F.arrow_udf(SKETCH)
    def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return giving_back(parts(batches))

    return sketched(text)


def keyed_set(text: Column, words: int) -> Column:
    """The set itself, as sorted 64-bit numbers, and its digest."""

    names = ["key1", "key2", "items"]

    def parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            empty = [pa.array([], kind) for kind in (pa.int64(), pa.int64(), pa.binary())]
            listed = [pa.StructArray.from_arrays(empty, names)]
            for found in _in_groups(batch, words):
                items = pa.array((s.tobytes() for s in found), pa.binary())
                listed.append(pa.StructArray.from_arrays([*_keys(found), items], names))
            yield pa.concat_arrays(listed)

    @F.arrow_udf("struct<key1: long, key2: long, items: binary>")
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return giving_back(parts(batches))

    # Else the filter on its digest would become a join key, and it would run on all rows.
    return sets.asNondeterministic()(text)


def estimate(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of sets of sizes n and m, given their registers."""
    more = (left > right).sum(axis=1)[:, None]
    less = (left < right).sum(axis=1)[:, None]
    same = left.shape[1] - more - less
    u = (n / (n + m))[:, None]
    v = 1 - u

    def chance(x):
        return -np.log1p(-np.maximum(x, 1e-12) * (BASE - 1) / BASE) / np.log(BASE)

    # Candidates up to the largest similarity the sizes allow.
    j = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)
    above, below = chance(u - v * j), chance(v - u * j)
    likelihood = (
        more * np.log(above) + less * np.log(below)
        + same * np.log(np.maximum(1 - above - below, 1e-12))
    )
    return np.take_along_axis(j, likelihood.argmax(axis=1)[:, None], axis=1)[:, 0]


def _linked(percent: int):
    """Whether two sets are linked: estimated from registers first, then confirmed."""
    deviation = (percent / 100 * (1 - percent / 100) / REGISTERS) ** 0.5
    floor = percent / 100 - 6 * deviation

    @F.arrow_udf(T.BooleanType())
    def linked(
        registers_a: pa.Array, registers_b: pa.Array, items_a: pa.Array, items_b: pa.Array
    ) -> pa.Array:
        found = []
        for i in range(0, len(items_a), 1024):
            rows = [
                np.frombuffer(b"".join(x.slice(i, 1024).to_pylist()), np.uint8).reshape(
                    -1, REGISTERS
                )
                for x in (registers_a, registers_b)
            ]
            sets = [
                [np.frombuffer(v.as_buffer(), np.uint64) for v in x.slice(i, 1024)]
                for x in (items_a, items_b)
            ]
            sizes = [np.array([len(x) for x in side], float) for side in sets]
            likely = estimate(*rows, *sizes) >= floor
            for near, one, two in zip(likely, *sets, strict=True):
                small, large = (one, two) if len(one) < len(two) else (two, one)
                shared = 0
                if near:
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    shared = int((large[at] == small).sum())
                union = len(one) + len(two) - shared
                found.append(bool(near) and 100 * shared >= percent * union)
        give_back()
        return pa.array(found, pa.bool_())

    return linked("registers_a", "registers_b", "items_a", "items_b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that are links."""
    for end in "ab":
        named = [F.col(c).alias(f"{c}_{end}") for c in ("registers", "items")]
        pairs = pairs.join(sets.select(F.col("node").alias(end), *named), end)
    return pairs.where(_linked(percent)).select("a", "b")


def _pair(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


@F.arrow_udf(T.ArrayType(T.LongType()))
def _difference(items: pa.Array, base: pa.Array) -> pa.Array:
    """What only one of two sets holds."""
    found = [
        np.setxor1d(
            np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64),
            assume_unique=True,
        ).view(np.int64)
        for a, b in zip(items, base, strict=True)
    ]
    listed = pa.array(found, pa.list_(pa.int64()))
    del found
    give_back()
    return listed


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _still_apart(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes with their roots, of the families that are in several components, and of how
    many nodes these are."""
    rooted = _rooted(nodes, roots)
    several = rooted.groupBy("family").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("n")
    )
    return rooted.join(several.where("least < most").select("family", "n"), "family")


def _near(apart: DataFrame, percent: int) -> DataFrame:
    """How far each node is from its family's base, and whether that is a link."""
    apart = apart.withColumn("apart", F.size("items"))
    both = F.col("n_shingles") + F.col("n_base")
    near = (100 + percent) * F.col("apart") <= (100 - percent) * both
    return apart.withColumn("near", near)


def _base_links(apart: DataFrame) -> DataFrame:
    return apart.where("near and node <> base").select(*_pair("node", "base"))


def _from_common(
    members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int, scratch: Scratch
) -> DataFrame:
    """Families of classes that may have links left, and how each differs from their base."""
    rooted = _rooted(members, roots)
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    # All that share a bucket share the family of its least root; a class may have several.
    rooted = scratch.keep(
        rooted.join(mixed.where("least < most"), "bucket").select(
            "node", "n_shingles", "centre", F.col("least").alias("family")
        ),
        "mixed",
    )
    bases = (
        rooted.groupBy("family", "centre").agg(F.count("*").alias("n"))
        .groupBy("family").agg(F.max(F.struct("n", "centre")).alias("top"))
        .select("family", F.col("top.centre").alias("base"))
    )
    nodes = rooted.select("node", "n_shingles", "family").distinct()
    based = bases.join(sets.select(F.col("node").alias("base"), "items"), "base").select(
        "family", "base", F.col("items").alias("base_items"),
        (F.length("items") / 8).cast("long").alias("n_base"),
    )
    apart = nodes.join(sets, "node").join(based, "family").select(
        "node", "n_shingles", "family", "base", "n_base",
        _difference("items", "base_items").alias("items"),
    )
    return scratch.keep(_near(apart, percent), "apart")


def _from_middle(
    apart: DataFrame, roots: DataFrame, percent: int, scratch: Scratch
) -> DataFrame:
    """Families still apart, and how each class differs from the one nearest to their middle.

    The middle holds what more than half of the family do. What the former base alone has
    or lacks is not in it, and no longer makes all others alike.
    """
    apart = scratch.keep(_still_apart(apart, roots).drop("root"), "still-apart")
    items = apart.select("family", "n", F.explode("items").alias("item"))
    # Fewer than twice what a member has on average, so one row holds a family's.
    usual = (
        items.groupBy("family", "n", "item").agg(F.count("*").alias("times"))
        .where("2 * times > n")
        .groupBy("family").agg(F.collect_list("item").alias("usual"))
    )
    # Both are kept, so that the join of a large family can be dealt over several tasks.
    usual = scratch.keep(usual, "usual")
    agreed = F.size(F.array_intersect("items", "usual"))
    # A node's distance from the middle, less that of the former base.
    further = apart.join(usual, "family").select(
        "family", "node", (F.col("apart") - 2 * agreed).alias("further")
    )
    middle = (
        scratch.keep(further.where("further < 0"), "further")
        .groupBy("family").agg(F.min(F.struct("further", "node")).alias("first"))
        .select("family", F.col("first.node").alias("node"))
    )
    middle = apart.join(middle, ["family", "node"]).select(
        "family", F.col("node").alias("middle"), F.col("n_shingles").alias("n_middle"),
        F.col("items").alias("moved"),
    )
    # Of two differences from one base, what only one holds is where their sets differ.
    moved = F.concat(F.array_except("items", "moved"), F.array_except("moved", "items"))
    rebased = apart.join(middle, "family", "left").select(
        "node", "n_shingles", "family",
        F.coalesce("middle", "base").alias("base"), F.coalesce("n_middle", "n_base").alias("n_base"),
        F.when(F.col("moved").isNull(), F.col("items")).otherwise(moved).alias("items"),
    )
    return scratch.keep(_near(rebased, percent), "from-middle")


def _rarest(apart: DataFrame, roots: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Of families still apart, the differences from the base that links have in common."""
    # |x - y| + |y - x| of linked sets is at most ``slack`` times |x| + |y|.
    slack = (100 - percent) / (100 + percent)
    apart = _still_apart(apart, roots)
    # Nodes near the base are one component. Of any other pair at least one is far. If a
    # pair is linked, the one that differs less from the base has few differences that
    # the other lacks, so among its rarest there is one of the other's rarest.
    size = F.col("n_shingles")
    wide = slack * (size + size * 100 / percent)
    narrow = F.when(
        F.col("near"),
        F.least(wide / 2, (F.col("apart") + slack * (size - F.col("n_base"))) / 2),
    ).otherwise(wide / 2)
    items = apart.select(
        "family", "n", "node", "apart", "n_shingles",
        wide.alias("wide"), narrow.alias("narrow"), F.explode("items").alias("item"),
    )
    common = items.groupBy("family", "item").agg(F.count("*").alias("times")).where("times > 1")
    # An item that no other node has leads to none, but takes its rank among the rarest.
    items = items.join(common, ["family", "item"], "left").withColumn(
        "times", F.coalesce("times", F.lit(1))
    )
    rarest = Window.partitionBy("family", "node").orderBy("times", "item")
    ranked = items.withColumn("rank", F.row_number().over(rarest)).where(
        "rank <= wide + 1.000001 and times > 1"
    )
    usual = F.expr("2 * times > n").alias("usual")
    return scratch.keep(ranked.select("*", usual).drop("wide", "times", "n"), "rarest")


def _closest(rarest: DataFrame, roots: DataFrame) -> DataFrame:
    """For each node the one it differs least from, of those that are nearest to the base
    among all that have an item; what most of the family have tells none from another."""
    rooted = _rooted(rarest, roots)
    centres = rooted.groupBy("family", "item").agg(
        F.min(F.struct("apart", "node", "root")).alias("c")
    )
    met = rooted.join(centres, ["family", "item"]).where("root <> c.root")
    shared = met.groupBy("family", "node", F.col("c.node").alias("centre")).agg(
        (2 * F.count(F.when(~F.col("usual"), 1)) - F.first("c.apart")).alias("weight")
    )
    most = shared.groupBy("node").agg(F.max(F.struct("weight", "centre")).alias("most"))
    return most.select("node", "most.centre").select(*_pair("node", "centre")).distinct()


def _across(rarest: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of nodes that still lie apart."""
    slack = (100 - percent) / (100 + percent)
    rooted = _rooted(rarest.drop("usual"), roots)
    # Pairs within the largest component, most of a family, aren't formed.
    largest = (
        rooted.groupBy("family", "root").agg(F.count("*").alias("n"))
        .groupBy("family").agg(F.max(F.struct("n", "root")).alias("top"))
        .select("family", F.col("top.root").alias("largest"))
    )
    rooted = rooted.join(largest, "family").withColumn("inside", F.col("root") == F.col("largest"))
    less = rooted.where("rank <= narrow + 1.000001").drop("narrow", "largest")
    less = less.toDF(*(c if c in ("family", "item") else f"{c}_a" for c in less.columns))
    more = rooted.drop("narrow", "largest")
    more = more.toDF(*(c if c in ("family", "item") else f"{c}_b" for c in more.columns))
    both = less.where("not inside_a").join(more, ["family", "item"]).unionByName(
        less.where("inside_a").join(more.where("not inside_b"), ["family", "item"])
    )
    most = f"{slack} * (n_shingles_a + n_shingles_b)"
    return (
        both.where("apart_a < apart_b or (apart_a = apart_b and node_a < node_b)")
        .where("root_a <> root_b")
        # What a linked pair's differences share is all but the slack; from these ranks on
        # it must still fit. In whole numbers first: sets just at the threshold are linked.
        .where(
            f"{100 + percent} * (apart_b - apart_a)"
            f" <= {100 - percent} * (n_shingles_a + n_shingles_b)"
        )
        .where(f"2 * rank_a <= apart_a - apart_b + {most} + 2.000001")
        .where(f"2 * rank_b <= apart_b - apart_a + {most} + 2.000001")
        .where(
            f"100 * least(n_shingles_a, n_shingles_b)"
            f" >= {percent} * greatest(n_shingles_a, n_shingles_b)"
        )
        .select(*_pair("node_a", "node_b"))
        .distinct()
    )


def _joined(roots: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) after further links, of which there are few between components."""
    for end in "ab":
        found = roots.select(F.col("node").alias(end), F.col("root").alias("r"))
        links = links.join(found, end, "left").withColumn(end, F.coalesce("r", end)).drop("r")
    tops = components(links.select("a", "b"), scratch, f"{name}-tops").toDF("root", "top")
    alone = tops.join(roots.select(F.col("node").alias("root")), "root", "left_anti")
    nodes = roots.union(alone.select(F.col("root").alias("node"), "root"))
    nodes = nodes.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return scratch.keep(nodes, name)


def _marked(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Ids and texts; a row without an id is found again by the hash of its text."""
    docs = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return docs.withColumn("mark", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))


def _resolved(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Each row's id, mark, set size, and its component's least id and least mark."""
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    rows = scratch.keep(
        docs.select("doc_id", "mark", sketch(F.col("text"), words).alias("s")).select(
            "doc_id", "mark", "s.*"
        ),
        "rows",
    )
    classes = rows.where("n_shingles > 0").groupBy("key1", "key2", "registers", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), F.min("mark").alias("mark")
    )
    classes = scratch.keep(
        classes.select(F.monotonically_increasing_id().alias("node"), "*"), "classes"
    )
    buckets = classes.select(
        "node", "n_shingles",
        F.explode(
            F.array(
                *[
                    F.xxhash64(F.lit(i), F.substring("registers", BAND * i + 1, BAND))
                    for i in range(BANDS)
                ]
            )
        ).alias("bucket"),
    )
    # The bucket's own bits draw its centre, another one in each band.
    centres = (
        buckets.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min(F.col("node").bitwiseXOR(F.col("bucket"))).alias("c"))
        .where("n > 1")
        .select("bucket", F.col("c").bitwiseXOR(F.col("bucket")).alias("centre"))
    )
    members = scratch.keep(buckets.join(centres, "bucket"), "members")

    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "key1", "key2", "registers", "doc_id",
        F.when(F.col("doc_id").isNull(), F.col("mark")).alias("mark"),
    )
    at = [wanted[c].eqNullSafe(docs[c]) for c in ("doc_id", "mark")]
    found = docs.join(wanted, at[0] & at[1]).select(
        "node", "key1", "key2", "registers", keyed_set(docs["text"], words).alias("s")
    )
    # Of rows that share an id, those whose set it is.
    own = (F.col("s.key1") == F.col("key1")) & (F.col("s.key2") == F.col("key2"))
    found = found.where(own).select("node", "registers", "s.items").dropDuplicates(["node"])
    sets = scratch.keep(found, "sets")

    meetings = members.where("node <> centre").groupBy("node", "centre").count()
    often = meetings.groupBy("node").agg(F.max(F.struct("count", "centre")).alias("most"))
    stars = often.select("node", F.col("most.centre").alias("centre"))
    edges = scratch.keep(
        _confirmed(stars.select(*_pair("node", "centre")).distinct(), sets, percent), "stars"
    )
    roots = scratch.keep(components(edges, scratch, "star-roots", rounds=2), "roots")
    apart = _from_common(members, roots, sets, percent, scratch)
    roots = _joined(roots, edges.union(_base_links(apart)), scratch, "near-common")
    apart = _from_middle(apart, roots, percent, scratch)
    roots = _joined(roots, _base_links(apart), scratch, "near-middle")
    rarest = _rarest(apart, roots, percent, scratch)
    closest = scratch.keep(_confirmed(_closest(rarest, roots), sets, percent), "closest")
    roots = _joined(roots, closest, scratch, "near-closest")
    across = scratch.keep(_confirmed(_across(rarest, roots, percent), sets, percent), "across")
    roots = _joined(roots, across, scratch, "linked")

    ids = (
        classes.join(roots, "node", "left")
        .select("key1", "key2", "doc_id", "mark", F.coalesce("root", "node").alias("root"))
    )
    ids = scratch.keep(ids, "ids")
    least = ids.groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.min("mark").alias("least_mark")
    )
    named = ids.join(least, "root").select("key1", "key2", "component_id", "least_mark")
    columns = ["doc_id", "mark", "n_shingles"]
    full = rows.where("n_shingles > 0").join(named, ["key1", "key2"]).select(
        *columns, "component_id", "least_mark"
    )
    empty = rows.where("n_shingles = 0").select(
        *columns, F.col("doc_id").alias("component_id"), F.col("mark").alias("least_mark")
    )
    return full.union(empty)


def near_duplicates(
    documents: DataFrame, words: int = 5, percent: int = 80,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """For each row its id, ``n_shingles``, the component's least id and ``kept``.

    Rows are linked when 100 * shared >= percent * all shingles of both.
    """
    rows = _resolved(_marked(documents, key, text), words, percent)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def first_of_each(
    documents: DataFrame, words: int = 5, percent: int = 80,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The documents that stay, one of each component, with all their columns.

    Of rows that repeat an id, one stays. A row without an id stays only if no row of its
    component has one, and then one text of the component stays once.
    """
    scratch = Scratch(documents.sparkSession, "first-of-each")
    marked = _marked(documents, key, text)
    stays = F.when(
        F.col("doc_id").isNull(),
        F.col("component_id").isNull() & (F.col("mark") == F.col("least_mark")),
    ).otherwise(F.col("doc_id") == F.col("component_id"))
    odd = (
        _resolved(marked, words, percent)
        .groupBy("doc_id", "mark")
        .agg(F.count("*").alias("times"), F.max(stays).alias("stays"))
        .where("not stays or times > 1")
    )
    # Rows that go or that repeat one another; all others aren't named.
    odd = scratch.keep(
        odd.toDF("__id", "__mark", "__times", "__stays"), "odd"
    )
    own = documents.columns
    keyed = documents.withColumn(
        "__own_mark", F.when(F.col(key).isNull(), F.xxhash64(text))
    )
    rows = keyed.join(
        odd,
        F.col(key).eqNullSafe(F.col("__id")) & F.col("__own_mark").eqNullSafe(F.col("__mark")),
        "left",
    )
    result = rows.where("__times is null").select(own)
    if not odd.where("__stays").isEmpty():
        again = rows.where("__stays").dropDuplicates(["__id", "__mark"])
        result = result.unionByName(again.select(own))
    return result
