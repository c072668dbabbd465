"""Toxicity by two class-conditional Kneser-Ney models of the letters in words.

A word is its letters between two marks. For each class the model of the next letter
takes the class's own counts at the longest context and, for what the class has seen
too rarely, one lower-order model that both classes share: Kneser-Ney continuation
counts over every document, labelled or not. So a rare expression is judged by the
letters it has in common with what the class knows, and what neither class knows is no
evidence. A word's evidence is its toxic minus its ordinary log-likelihood; a document's
is that of the whole text divided by its length, and that of its strongest words, since
a few words make a long text toxic. A logistic calibration turns these into a score.

Counts cover every document, and all labelled ones of the fold they are from. They are
kept by letter group in tables that grow with the corpus, and so is the evidence: nothing
of it goes to the driver. To score, documents are put into blocks; each distinct letter
group of a block is joined with its evidence, which goes back to the block.

Folds, by the remainder of an id's CRC-32 by 3: 0 counts the classes, 2 calibrates (at
most ``SAMPLE`` rows, those of least hashed id), 1 is held out.

Results by case: a text without letters, or null, has no evidence and the score that
the calibration gives to that; without toxic and ordinary rows in both folds every
score is the share of toxic rows among the labelled, or 0; a row without an id is not
held out and teaches nothing but the shared counts; a label of null is none; repeated
rows give repeated rows; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskstream.llm.common import Scratch, mix

ORDER = 5
DISCOUNT = 0.75
SAMPLE = 6000
TOP = 3  # strongest words that count on their own
THRESHOLD = 0.7
MOST_WORDS = 400_000  # words that a worker counts before it passes on their letter groups
BLOCK = 1 << 23  # characters of the documents that get their evidence together
TOGETHER = 50_000  # words whose letters are worked on at once
_LETTERS = re.compile(r"[^\W\d_]+")

START, END = "\x02", "\x03"  # the marks around a word
COUNTS = "gram string, kind int, n long"


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 3


class _Grams(NamedTuple):
    """Letter groups of one order in a list of words."""

    word: np.ndarray  # whose they are
    slot: np.ndarray  # a 64-bit hash, to tell them apart among few words
    end: np.ndarray  # where their last letters are in ``_codes``
    started: np.ndarray  # whether they begin with the mark before the word


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(f"{START}{w}{END}" for w in words).encode("utf-32-le"), np.uint32)


def _grams(words: list[str]) -> list[_Grams]:
    """Letter groups of order 1 to ``ORDER``, the mark in front never last."""
    codes = _codes(words)
    starts = np.flatnonzero(codes == ord(START))
    lengths = np.diff(np.append(starts, len(codes)))
    word = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    letters = codes.astype(np.uint64)
    # hashes[i]: the n letters that end at i.
    hashes, grams = np.zeros(len(codes), np.uint64), []
    for n in range(1, ORDER + 1):
        before = np.concatenate([[np.uint64(0)], hashes[:-1]])
        hashes = mix(before * np.uint64(31) + letters + np.uint64(n << 32))
        at = np.flatnonzero(place >= max(n - 1, 1))
        grams.append(_Grams(word[at], hashes[at], at, place[at] == n - 1))
    return grams


def _distinct(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each slot, and where each number comes first."""
    numbers, found = pd.factorize(slots)
    first = np.empty(len(found), np.int64)
    first[numbers[::-1]] = np.arange(len(slots))[::-1]
    return numbers, first


def _letters(codes: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """The letter groups that end there, as text."""
    if not len(ends):
        return np.empty(0, f"U{order}")
    groups = np.lib.stride_tricks.sliding_window_view(codes, order)[ends - order + 1]
    return np.ascontiguousarray(groups).view(f"U{order}").ravel()


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def _counted(kind: int):
    """Counts of the letter groups of a partition's texts."""

    def rows(words: Counter) -> Iterator[pa.RecordBatch]:
        listed = list(words)
        parts: list[list] = [[] for _ in range(ORDER)]
        for i in range(0, len(listed), TOGETHER):
            group = listed[i : i + TOGETHER]
            times = np.fromiter(map(words.__getitem__, group), float, len(group))
            codes = _codes(group)
            for order, (part, g) in enumerate(zip(parts, _grams(group), strict=True), 1):
                numbers, first = _distinct(g.slot)
                n = np.bincount(numbers, times[g.word], len(first))
                part.append((g.slot[first], n, _letters(codes, g.end[first], order)))
        for part in parts:
            if not part:
                continue
            slots, n, letters = (np.concatenate(column) for column in zip(*part, strict=True))
            numbers, first = _distinct(slots)
            n = np.bincount(numbers, n, len(first)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(letters[first].tolist(), pa.string()),
                 pa.array(np.full(len(n), kind, np.int32)), pa.array(n)],
                names=["gram", "kind", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                words.update(words_of(value.as_py()))
                if len(words) > MOST_WORDS:
                    yield from rows(words)
                    words = Counter()
        yield from rows(words)

    return count


def _count_grams(documents: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(order, gram, n0, n1, n2): counts in toxic, ordinary and all documents."""
    docs = documents.select("doc_id", "text")
    # Sorted and merged at any size: the labels grow with the corpus.
    fold_of = labels.where(fold(F.col("doc_id")) == 0).hint("merge")
    taught = docs.join(fold_of, "doc_id")
    taught = scratch.keep(taught.select("text", "toxic"), "taught")
    counts = docs.select("text").mapInArrow(_counted(2), COUNTS)
    for kind, label in ((0, 1), (1, 0)):
        of_class = taught.where(F.col("toxic") == label).select("text")
        counts = counts.union(of_class.mapInArrow(_counted(kind), COUNTS))
    grams = counts.groupBy("gram").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(f"n{k}")
            for k in range(3)
        ]
    )
    grams = scratch.keep(grams.select(F.length("gram").alias("order"), "*"), "grams")
    scratch.drop("taught")
    return grams


def _evidence(grams: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram, evidence): the log-likelihood of toxic against ordinary.

    Of the groups that judge a letter: the longest, and those that begin a word.
    """
    letters = max(1, grams.where("order = 1 and n2 > 0").count())
    # Contexts and suffixes have at most as many groups as there are letters.
    of_context = Window.partitionBy("context")

    def interpolated(count: str) -> Column:
        total = F.sum(count).over(of_context)
        kinds = F.sum((F.col(count) > 0).cast("double")).over(of_context)
        own = F.greatest(F.col(count) - DISCOUNT, F.lit(0.0)) + DISCOUNT * kinds * F.col("lower")
        return F.when(total > 0, own / total).otherwise(F.col("lower"))

    def judged(gram_class: str) -> Column:
        return F.log(F.greatest(F.col(gram_class), F.lit(1e-12)))

    found, below = [], None
    for n in range(1, ORDER + 1):
        order = grams.where(F.col("order") == n).select(
            "gram", "n0", "n1", "n2", F.col("gram").startswith(START).alias("started"),
            F.substring("gram", 1, n - 1).alias("context"),
            F.substring("gram", 2, n - 1).alias("suffix"),
        )
        if below is None:
            order = order.withColumn("lower", F.lit(1.0 / letters))
        else:
            order = order.join(
                below.select(F.col("gram").alias("suffix"), F.col("below").alias("lower")), "suffix"
            )
        order = order.withColumn("continued", F.lit(0))
        if n < ORDER:
            # How many letters precede a group; a word's beginning has none but itself.
            above = grams.where((F.col("order") == n + 1) & (F.col("n2") > 0))
            above = above.groupBy(F.substring("gram", 2, n).alias("gram")).agg(
                F.count("*").alias("preceding")
            )
            order = order.join(above, "gram", "left").withColumn(
                "continued",
                F.when(F.col("started"), F.col("n2")).otherwise(
                    F.coalesce("preceding", F.lit(0))
                ),
            )
        order = order.select(
            "gram", "started", (F.col("n2") > 0).alias("known"),
            *[
                interpolated(c).alias(name)
                for c, name in (("n0", "toxic"), ("n1", "ordinary"), ("continued", "below"))
            ],
        )
        evidence = F.when(F.col("known"), judged("toxic") - judged("ordinary")).otherwise(0.0)
        below = scratch.keep(
            order.select("gram", "started", evidence.cast("float").alias("evidence"), "below"),
            f"order{n}",
        )
        # A letter is judged once, after its longest context.
        found.append(below.where(F.lit(n == ORDER) | F.col("started")).select("gram", "evidence"))
    result = found[0]
    for frame in found[1:]:
        result = result.union(frame)
    return result


class _Used(NamedTuple):
    """The letter groups that judge the letters of a list of words."""

    word: np.ndarray  # of each letter
    number: np.ndarray  # of its group
    grams: list[str]  # by number; each once


def _used(words: list[str]) -> _Used:
    owners, slots, letters = [], [], []
    for i in range(0, len(words), TOGETHER):
        group = words[i : i + TOGETHER]
        codes = _codes(group)
        for n, g in enumerate(_grams(group), 1):
            use = np.ones(len(g.slot), bool) if n == ORDER else g.started
            numbers, first = _distinct(g.slot[use])
            owners.append(g.word[use] + i)
            slots.append((g.slot[use][first], numbers))
            letters.append(_letters(codes, g.end[use][first], n).astype(f"U{ORDER}"))
    if not owners:
        return _Used(np.empty(0, np.int64), np.empty(0, np.int64), [])
    numbers, first = _distinct(np.concatenate([s for s, _ in slots]))
    starts = np.cumsum([0] + [len(s) for s, _ in slots])
    number = [numbers[start + n] for start, (_, n) in zip(starts, slots, strict=False)]
    return _Used(
        np.concatenate(owners), np.concatenate(number), np.concatenate(letters)[first].tolist()
    )


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a partition's documents, which are bags of the block's words."""
    part, made = TaskContext.get().partitionId() << 32, 0
    index: defaultdict = defaultdict()
    index.default_factory = index.__len__
    ids, bags, chars = [], [], 0

    def block() -> pa.RecordBatch:
        sizes = np.array([len(bag) for bag in bags], np.int32)
        # Differences in ascending order and byte by byte: most bytes are zero.
        steps = np.diff(np.concatenate([*bags, np.empty(0, np.int32)]), prepend=np.int32(0))
        packed = steps.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
        row = [
            pa.array([part + made]), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(kind)),
            pa.array([sizes], pa.list_(pa.int32())),
            pa.array([zlib.compress(packed, 1)], pa.binary()),
            pa.array([zlib.compress(" ".join(index).encode(), 1)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(row, names=["block", "ids", "sizes", "bags", "words"])

    for batch in batches:
        kind, texts = batch.column(0).type, batch.column(1)
        begun = 0
        for i in range(len(batch)):
            text = texts[i].as_py()
            words = words_of(text)
            bag = np.fromiter(map(index.__getitem__, words), np.int32, len(words))
            bags.append(np.sort(bag))
            chars += len(text or "") + 100
            if chars >= BLOCK:
                ids.append(batch.column(0).slice(begun, i + 1 - begun))
                yield block()
                index.clear()
                ids, bags, chars, made, begun = [], [], 0, made + 1, i + 1
        ids.append(batch.column(0).slice(begun))
    if bags:
        yield block()


def _unpacked(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<i4").ravel(), dtype=np.int64)


def _words(packed: bytes) -> list[str]:
    return zlib.decompress(packed).decode().split()


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letter groups of each block, numbered."""
    for batch in batches:
        for block, words in zip(*batch.columns, strict=True):
            grams = _used(_words(words.as_py())).grams
            columns = [
                pa.array(np.full(len(grams), block.as_py())),
                pa.array(np.arange(len(grams), dtype=np.int32)), pa.array(grams, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "number", "gram"])


def _bag_features(totals: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Evidence of a whole text, of its strongest words, and its size."""
    found = np.zeros(TOP + 2)
    if len(totals):
        found[0] = totals.sum() / lengths.sum()
        top = np.sort(totals)[::-1][:TOP]
        found[1 : 1 + len(top)] = top
        found[-1] = np.log1p(len(totals)) / 10
    return found


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of the documents of blocks that have got their evidence."""
    for batch in batches:
        for row in range(len(batch)):
            ids, sizes, bags, words, numbers, values = (c[row] for c in batch.columns)
            listed = _words(words.as_py())
            used = _used(listed)
            evidence = np.zeros(len(used.grams))
            if numbers.is_valid:
                evidence[numbers.values.to_numpy()] = values.values.to_numpy()
            # A word's log-likelihood ratio, in total; its length counts the end mark.
            totals = np.bincount(used.word, evidence[used.number], len(listed))
            lengths = np.fromiter(map(len, listed), float, len(listed)) + 1
            ends = np.cumsum(sizes.values.to_numpy())
            parts = np.split(_unpacked(bags.as_py()), ends[:-1])
            features = [_bag_features(totals[bag], lengths[bag]) for bag in parts]
            yield pa.RecordBatch.from_arrays(
                [ids.values, pa.array(features, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )


class Model(NamedTuple):
    evidence: DataFrame  # (gram, evidence)
    weights: np.ndarray  # of the features, and last of one


def _logistic(x: np.ndarray, y: np.ndarray, shrink: float = 1e-3) -> np.ndarray:
    """Weights by Newton's method; the last is the constant's."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ weights)))
        slope = x.T @ (y - p) / len(y) - shrink * weights
        bend = (x.T * (p * (1 - p))) @ x / len(y) + shrink * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _features(documents: DataFrame, evidence: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, x), one row for each row (doc_id, text) of ``documents``."""
    key = documents.schema["doc_id"].dataType
    kind = (
        T.StructType().add("block", "long").add("ids", T.ArrayType(key))
        .add("sizes", T.ArrayType(T.IntegerType())).add("bags", "binary").add("words", "binary")
    )
    blocks = scratch.keep(
        documents.select("doc_id", "text").mapInArrow(_blocked, kind), "blocks"
    )
    asked = blocks.select("block", "words").mapInArrow(
        _asked, "block long, number int, gram string"
    )
    known = asked.join(evidence, "gram").groupBy("block").agg(
        F.collect_list(F.struct("number", "evidence")).alias("found")
    )
    rows = blocks.join(known, "block", "left").select(
        "ids", "sizes", "bags", "words", "found.number", "found.evidence"
    )
    features = T.StructType().add("doc_id", key).add("x", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(_read, features)


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Count the classes on one fold and calibrate on another."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "toxicity")
    labels = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    evidence = _evidence(_count_grams(documents, labels, scratch), scratch)
    chosen = (
        labels.where(fold(F.col("doc_id")) == 2).orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    toxic = {row.doc_id: row.toxic for row in chosen.collect()}
    sampled = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = _features(sampled, evidence, scratch).collect()
    scratch.drop("blocks")
    rows.sort(key=lambda row: (row.doc_id, row.x))
    y = np.array([toxic[row.doc_id] for row in rows], float)
    if not 0 < y.sum() < len(y):
        weights = np.zeros(TOP + 3)
        share = y.mean() if len(y) else 0.0
        weights[-1] = np.log((share + 1e-9) / (1 - share + 1e-9))
        return Model(evidence, weights)
    return Model(evidence, _logistic(np.array([row.x for row in rows]), y))


def toxicity(
    documents: DataFrame, model: Model, threshold: float = THRESHOLD,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    docs = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = _features(docs, model.evidence, Scratch(documents.sparkSession, "toxicity"))
    sums = sum(
        (F.col("x")[i] * float(w) for i, w in enumerate(model.weights[:-1])),
        F.lit(float(model.weights[-1])),
    )
    return rows.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        (1 / (1 + F.exp(-sums))).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
