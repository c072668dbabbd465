"""A graded quality classifier: ordinal regression with cumulative links.

A document has hashed-text features: the square roots of its word and word-pair counts
in ``BUCKETS`` buckets, and shares of kinds of characters, scaled to length one. One
weight vector, shared by all grades, gives a document a position; ordered thresholds cut
positions into grades:

    P(grade <= k) = 1 / (1 + exp(position - threshold k)).

The fit maximises the likelihood of graded ratings by Adam steps, with the gaps between
thresholds kept positive by fitting their logarithms. It takes at most ``SAMPLE`` rated
documents, those whose hashed ids are least. Every document is then given its expected
grade and the probability of reaching the grade ``LEAST``, which decides.

Results by case: a null or empty text has no features and the position zero; ratings of
null count as none; without two different grades nothing is learnt and all documents
stay at the only grade, or 0; a row without an id is judged and teaches nothing;
repeated rows give repeated rows; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import WHITE

BUCKETS = 1 << 14
SAMPLE = 4000
LEAST = 1  # the grade to be reached
KEEP = 0.5  # with this probability

GRADED = "struct<position: double, expected_grade: double, tail: double>"

# Kinds of characters whose share is a feature of its own.
_KINDS = ("#*$%&|<>", "!?", ".,;:", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", WHITE)
_SHARES = len(_KINDS) + 1
WIDTH = BUCKETS + _SHARES


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features; the values' squares sum to one and a bit."""
    words = (text or "").lower().encode().split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    one = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS
    pairs = (one[:-1] * 31 + one[1:] * 17 + 7) % BUCKETS
    counts = np.bincount(np.concatenate([one, pairs]), minlength=1)
    places = np.flatnonzero(counts)
    values = np.sqrt(counts[places])
    values /= np.sqrt((values**2).sum())
    shares = [sum(map(text.count, kind)) / len(text) for kind in _KINDS]
    shares.append(1 - len(set(words)) / len(words))
    return (
        np.concatenate([places, np.arange(BUCKETS, WIDTH)]),
        np.concatenate([values, np.sqrt(shares)]),
    )


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray  # one less than grades
    grades: np.ndarray


def _rows(found: list[tuple[np.ndarray, np.ndarray]]):
    """Row number, place and value of all features."""
    row = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
    return (
        row, np.concatenate([p for p, _ in found]), np.concatenate([v for _, v in found])
    )


def fit(
    found: list[tuple[np.ndarray, np.ndarray]], ratings: np.ndarray,
    steps: int = 200, rate: float = 0.1, shrink: float = 1e-4,
) -> Model:
    """Shared weights and ordered thresholds of rated texts' features."""
    grades, rank = np.unique(ratings, return_inverse=True)
    if len(grades) < 2:
        return Model(np.zeros(WIDTH), np.empty(0), grades if len(grades) else np.zeros(1))
    row, place, value = _rows(found)
    cuts = len(grades) - 1
    below = np.cumsum(np.bincount(rank))[:-1] / len(rank)
    start = np.log(below / (1 - below))
    # The first threshold, then logarithms of the gaps.
    state = np.concatenate([np.zeros(WIDTH), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    first, second = np.zeros_like(state), np.zeros_like(state)
    for t in range(1, steps + 1):
        position = np.bincount(row, value * state[place], len(rank))
        gaps = np.exp(state[WIDTH + 1 :])
        edges = np.concatenate(
            [[-np.inf], state[WIDTH] + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]]
        )
        low, high = (1 / (1 + np.exp(position - edges[rank + i])) for i in (0, 1))
        chance = np.maximum(high - low, 1e-12)
        at_low, at_high = low * (1 - low) / chance, high * (1 - high) / chance
        slope = np.zeros_like(state)
        pull = (at_low - at_high) / len(rank)
        slope[:WIDTH] = np.bincount(place, value * pull[row], WIDTH)
        by_edge = np.bincount(rank + 1, at_high, cuts + 2) - np.bincount(rank, at_low, cuts + 2)
        by_edge = by_edge[1:-1] / len(rank)
        slope[WIDTH] = by_edge.sum()
        slope[WIDTH + 1 :] = gaps * (np.cumsum(by_edge[::-1])[::-1][1:])
        slope[:WIDTH] -= shrink * state[:WIDTH]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        state = state + rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    edges = state[WIDTH] + np.concatenate([[0], np.cumsum(np.exp(state[WIDTH + 1 :]))])
    return Model(state[:WIDTH], edges, grades)


def grade(model: Model, position: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade, and probability of at least the grade ``least``."""
    reached = 1 / (1 + np.exp(model.thresholds[None, :] - position[:, None]))
    edge = np.column_stack([np.ones(len(position)), reached, np.zeros(len(position))])
    chances = edge[:, :-1] - edge[:, 1:]
    return chances @ model.grades, chances[:, model.grades >= least].sum(axis=1)


def graded(text: Column, model: Model, least: float) -> Column:
    @F.arrow_udf(GRADED)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            position = np.zeros(len(batch))
            for i, value in enumerate(batch):
                place, values = features(value.as_py())
                position[i] = values @ model.weights[place]
            columns = [position, *grade(model, position, least)]
            yield pa.StructArray.from_arrays(
                [pa.array(c, pa.float64()) for c in columns],
                names=["position", "expected_grade", "tail"],
            )

    return judged(text)


def _listed(text: Column) -> Column:
    @F.arrow_udf("struct<place: array<long>, value: array<double>>")
    def listed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [features(value.as_py()) for value in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([p for p, _ in found], pa.list_(pa.int64())),
                 pa.array([v for _, v in found], pa.list_(pa.float64()))],
                names=["place", "value"],
            )

    return listed(text)


def learn(documents: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit to (doc_id, grade) rows; of several grades of an id the least counts."""
    chosen = (
        ratings.where("doc_id is not null and grade is not null")
        .groupBy("doc_id").agg(F.min("grade").cast("double").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # A text has at most ``WIDTH`` features, so this is bounded whatever its length.
    rows = rows.dropDuplicates(["doc_id"]).select(
        "doc_id", "grade", _listed(F.col("text")).alias("x")
    ).collect()
    rows.sort(key=lambda r: r.doc_id)
    return fit(
        [(np.array(r.x.place, np.int64), np.array(r.x.value)) for r in rows],
        np.array([r.grade for r in rows]),
    )


def quality_grades(
    documents: DataFrame, model: Model, least: float = LEAST, keep: float = KEEP,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, position, expected_grade, tail, kept)."""
    rows = documents.select(F.col(key), graded(F.col(text), model, least).alias("g"))
    return rows.select(key, "g.*").withColumn("kept", F.col("tail") >= keep)
