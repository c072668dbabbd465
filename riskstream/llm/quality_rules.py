"""Quality rules: a linear-chain conditional random field marks lines of boilerplate.

The lines of a text that hold a word form a sequence. Each line has features of its
own (shares of symbols, capitals, digits, repeats and so on); neighbouring lines are
tied by transition weights. Viterbi decoding finds the likeliest labels of all lines
together, and the share of words in content lines decides whether a document stays.
Plain counts come first, and fail a document that is too short or repeats itself.

The field is fitted to document labels only: a good document's lines are content. A
poor document's lines start as boilerplate and are relabelled by the fitted field in
turn, as long as one line stays boilerplate, since good lines occur in poor documents
too. The fit takes at most ``SAMPLE`` documents of each label, those whose hashed ids are
least, so it is the same on any cluster. A document teaches by chunks of ``CHUNK`` lines,
each a sequence; of one with more than ``CHUNKS`` it takes as many, evenly spaced from
its first to its last.

Results by case: a null or empty text has no words and fails; without labels of both
kinds nothing is learnt and only the plain counts decide; a row without an id is judged
like any other; repeated rows give repeated rows; extra columns are ignored; an empty
table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import WHITE, giving_back, shingles

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
REPEAT = 8  # words of a window
CONTENT_SHARE = 0.5

SAMPLE = 400
CHUNK = 256
CHUNKS = 8
ROUNDS = 3

VERDICT = (
    "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, "
    "n_repeat_words: long, base_failed: boolean, content_share: double, kept: boolean>"
)

# Kinds of bytes whose share of a line is a feature.
_KINDS = {
    "symbol": SYMBOLS.encode(),
    "mark": b"!?=/\\_~^+@[]{}();:\"'",
    "stop": b".,",
    "capital": bytes(range(65, 91)),
    "digit": b"0123456789",
}
_IS = [np.isin(np.arange(256), list(kind)).astype(np.int32) for kind in _KINDS.values()]
_SPACE = np.isin(np.arange(256), list(WHITE.encode()))
_BARE = frozenset(bytes([c]) for c in SYMBOLS.encode())
# Capitals of the Latin-1 letters are the second byte after this one.
_LATIN, _LATIN_CAPITAL = 0xC3, range(0x80, 0x9F)
FEATURES = ["one", *_KINDS, "short", "log_words", "word_length", "repeated_line", "distinct", "echoed",
            "bare"]


class Field(NamedTuple):
    """Weights: features to the log-odds of boilerplate, and between labels."""

    weights: np.ndarray
    moves: np.ndarray  # from label, to label; 0 is content


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line that holds a word, and its number of words."""
    data = text.encode()
    lines = data.split(b"\n")
    codes = np.frombuffer(data + b"\n", np.uint8)
    starts = np.concatenate([[0], np.flatnonzero(codes == 10)[:-1] + 1])
    space = _SPACE[codes]
    begins = ~space & np.concatenate([[True], space[:-1]])
    words = np.add.reduceat(begins.astype(np.int32), starts)
    inked = np.add.reduceat((~space).astype(np.int32), starts)
    used = words > 0
    shares = []
    for name, kind in zip(_KINDS, _IS, strict=True):
        hits = kind[codes]
        if name == "capital":
            follows = (codes[:-1] == _LATIN) & np.isin(codes[1:], _LATIN_CAPITAL)
            hits[1:] += follows
        shares.append(np.add.reduceat(hits, starts)[used] / inked[used])
    words, inked = words[used], inked[used]
    seen: set[bytes] = set()
    repeated, distinct, echoed, bare = [], [], [], []
    for line, is_used in zip(lines, used, strict=True):
        if is_used:
            repeated.append(line in seen)
            seen.add(line)
            parts = line.split()
            distinct.append(len(set(parts)) / len(parts))
            echoed.append(sum(map(bytes.__eq__, parts, parts[1:])) / len(parts))
            bare.append(sum(map(_BARE.__contains__, parts)) / len(parts))
    columns = [
        np.ones(len(words)), *[np.minimum(1, 4 * s) for s in shares], words < 3,
        np.log1p(words) / 5, np.minimum(1, inked / words / 20), repeated, distinct, echoed,
        bare,
    ]
    return np.array(columns, float).T.reshape(-1, len(FEATURES)), words


def viterbi(field: Field, features: np.ndarray) -> np.ndarray:
    """The likeliest labels of a line sequence; 1 is boilerplate. Ties go to content."""
    odds = (features @ field.weights).tolist()
    (cc, cb), (bc, bb) = field.moves.tolist()
    content, boiler = 0.0, odds[0] if odds else 0.0
    back = []
    for odd in odds[1:]:
        from_c, from_b = content + cc >= boiler + bc, content + cb >= boiler + bb
        back.append((from_c, from_b))
        content, boiler = (
            content + cc if from_c else boiler + bc,
            (content + cb if from_b else boiler + bb) + odd,
        )
    labels = np.zeros(len(odds), np.int8)
    label = int(boiler > content)
    for i in range(len(odds) - 1, -1, -1):
        labels[i] = label
        if i:
            label = int(not back[i - 1][label])
    return labels


def _gradient(field: Field, x: np.ndarray, y: np.ndarray, mask: np.ndarray):
    """Gradient of the mean log-likelihood of label sequences, by forward and backward sums.

    x: document, line, feature; y: labels; mask: which lines exist.
    """
    documents, lines, _ = x.shape
    odds = np.zeros((documents, lines, 2))
    odds[..., 1] = x @ field.weights
    forward, backward = np.empty_like(odds), np.zeros_like(odds)
    forward[:, 0] = odds[:, 0]
    for i in range(1, lines):
        step = np.logaddexp.reduce(forward[:, i - 1, :, None] + field.moves, axis=1) + odds[:, i]
        forward[:, i] = np.where(mask[:, i, None], step, forward[:, i - 1])
    for i in range(lines - 2, -1, -1):
        step = np.logaddexp.reduce(
            field.moves + (odds[:, i + 1] + backward[:, i + 1])[:, None, :], axis=2
        )
        backward[:, i] = np.where(mask[:, i + 1, None], step, backward[:, i + 1])
    total = np.logaddexp.reduce(forward[:, -1], axis=1)[:, None]
    expected = np.exp(forward[..., 1] + backward[..., 1] - total) * mask
    off = (y * mask - expected).ravel().astype(x.dtype)
    weights = off @ x.reshape(-1, x.shape[2])
    both = (mask[:, 1:] & mask[:, :-1])[..., None, None]
    pair = np.exp(
        forward[:, :-1, :, None] + field.moves + (odds + backward)[:, 1:, None, :]
        - total[..., None, None]
    )
    held = (y[:, :-1, None, None] == np.array([[[[0], [1]]]])) & (
        y[:, 1:, None, None] == np.array([[[[0, 1]]]])
    )
    moves = ((held - pair) * both).sum(axis=(0, 1))
    return weights / mask.sum(), moves / mask.sum()


class _Sequences(NamedTuple):
    """Sequences of like length, padded to the longest of them."""

    x: np.ndarray
    y: np.ndarray
    mask: np.ndarray
    owners: np.ndarray  # the document of each


def _padded(documents: list[tuple[list[np.ndarray], bool]]) -> list[_Sequences]:
    """All sequences by the power of two that holds their length, so at most half is padding."""
    kinds: dict[int, list[tuple[int, np.ndarray]]] = {}
    for owner, (chunks, _) in enumerate(documents):
        for rows in chunks:
            kinds.setdefault(len(rows).bit_length(), []).append((owner, rows))
    groups = []
    for _, held in sorted(kinds.items()):
        longest = max(len(rows) for _, rows in held)
        x = np.zeros((len(held), longest, len(FEATURES)), np.float32)
        mask = np.zeros((len(held), longest), bool)
        for i, (_, rows) in enumerate(held):
            x[i, : len(rows)], mask[i, : len(rows)] = rows, True
        owners = np.array([owner for owner, _ in held])
        poor = np.array([documents[owner][1] for owner in owners])
        groups.append(_Sequences(x, (mask & poor[:, None]).astype(float), mask, owners))
    return groups


def _slope(field: Field, groups: list[_Sequences]) -> np.ndarray:
    total = sum(int(group.mask.sum()) for group in groups)
    slope = np.zeros(len(field.weights) + 4)
    for x, y, mask, _ in groups:
        parts = [part.ravel() for part in _gradient(field, x, y, mask)]
        slope += np.concatenate(parts) * (mask.sum() / total)
    return slope


def _ascend(
    field: Field, groups: list[_Sequences], steps: int, rate: float, shrink: float
) -> Field:
    """Adam on the penalised likelihood."""
    state = np.concatenate([field.weights, field.moves.ravel()])
    first, second = np.zeros_like(state), np.zeros_like(state)
    n = len(field.weights)
    for t in range(1, steps + 1):
        at = Field(state[:n], state[n:].reshape(2, 2))
        slope = _slope(at, groups) - shrink * state
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        state = state + rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return Field(state[:n], state[n:].reshape(2, 2))


def fit(documents: list[tuple[list[np.ndarray], bool]]) -> Field | None:
    """A field from (line features of each sequence, whether the document is poor) pairs."""
    documents = [([x for x in chunks if len(x)], poor) for chunks, poor in documents]
    if len({poor for chunks, poor in documents if chunks}) < 2:
        return None
    groups = _padded(documents)
    poor = [poor for _, poor in documents]
    field = Field(np.zeros(len(FEATURES)), np.zeros((2, 2)))
    for _ in range(ROUNDS):
        field = _ascend(field, groups, steps=60, rate=0.2, shrink=1e-4)
        labels = [
            {i: viterbi(field, x[i, mask[i]]) for i, owner in enumerate(owners) if poor[owner]}
            for x, _, mask, owners in groups
        ]
        # A poor document keeps its labels while none of its lines would be boilerplate.
        boiler = {
            int(group.owners[i])
            for group, own in zip(groups, labels, strict=True)
            for i, found in own.items()
            if found.any()
        }
        for group, own in zip(groups, labels, strict=True):
            for i, found in own.items():
                if int(group.owners[i]) in boiler:
                    group.y[i, : len(found)] = found
    return field


def judge(text: str | None, field: Field | None) -> tuple:
    """The fields of ``VERDICT`` for one text."""
    text = text or ""
    n_words = len(text.encode().split())
    word_chars = len(text) - sum(map(text.count, WHITE))
    n_symbols = sum(map(text.count, SYMBOLS))
    # Lines with a word; a line's words are those of its bytes.
    lines = [line for line in text.encode().split(b"\n") if line.split()]
    n_dup_lines = len(lines) - len(set(lines))
    windows = shingles(text, REPEAT)
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    edges = np.zeros(n_words + 1, np.int64)
    twice = np.flatnonzero(times[place] > 1) if len(windows) else np.empty(0, np.int64)
    edges[twice] += 1
    edges[twice + REPEAT] -= 1
    n_repeat_words = int((np.cumsum(edges) > 0).sum())
    failed = n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words
    share = 1.0 if n_words else 0.0
    if field is not None and n_words:
        features, words = line_features(text)
        share = float(words[viterbi(field, features) == 0].sum() / words.sum())
    return (
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed, share,
        not failed and share >= CONTENT_SHARE,
    )


def verdict(text: Column, field: Field | None) -> Column:
    """``VERDICT`` of a text column."""
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "content_share", "kept"]

    def verdicts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = list(zip(*(judge(v.as_py(), field) for v in batch), strict=True))
            columns = columns or [()] * len(kinds)
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    @F.arrow_udf(VERDICT)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return giving_back(verdicts(batches))

    return judged(text)


def taught(text: str, size: int = CHUNK, most: int = CHUNKS) -> list[np.ndarray]:
    """Line features of a text's chunks, or of ``most`` of them spaced over all of it."""
    lines = line_features(text)[0].astype(np.float32)
    starts = range(0, len(lines), size)
    if len(starts) > most:
        places = np.linspace(0, len(starts) - 1, most).round().astype(int)
        starts = [starts[i] for i in places]
    return [lines[i : i + size] for i in starts]


def _features(text: Column) -> Column:
    @F.arrow_udf("array<binary>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [[chunk.tobytes() for chunk in taught(v.as_py())] for v in batch]
            yield pa.array(found, pa.list_(pa.binary()))

    return features(text)


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Fit the field to at most ``sample`` documents of each quality label."""
    labels = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = labels.where("q = 0").orderBy(*order).limit(sample).union(
        labels.where("q = 1").orderBy(*order).limit(sample)
    )
    # At most 2 * sample rows of two numbers; then as many of CHUNKS * CHUNK lines each.
    texts = documents.select("doc_id", "text").where("text is not null")
    rows = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    found = rows.select("doc_id", "q", _features(F.col("text")).alias("x")).collect()
    found.sort(key=lambda row: row.doc_id)
    shape = (-1, len(FEATURES))
    return fit(
        [([np.frombuffer(x, np.float32).reshape(shape) for x in r.x], r.q == 0) for r in found]
    )


def quality_rules(
    documents: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Key and the fields of ``VERDICT``."""
    return documents.select(F.col(key), verdict(F.col(text), field).alias("v")).select(key, "v.*")


def kept_documents(documents: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    return documents.where(verdict(F.col(text), field)["kept"])
