"""Exact token counts by a finite-state transducer compiled from the vocabulary.

A byte-fallback BPE vocabulary is compiled, on demand, to a deterministic
transducer over characters. Each transition carries the number of tokens by
which one more character changes the count: the count of a text is the sum
over its transitions.

Why finite state suffices: the tokens of a prefix end in one last token, and the
rest is what the prefix before it gives. A token may follow another if the two,
merged alone, stay two. So the last token at a new position is the one vocabulary
entry ending there that may follow the last token where it begins. A state
therefore holds, for each place at which a longer entry may still have begun, the
last token there and how many tokens ended since.

Texts are cut into chunks. A chunk maps the state it is entered in to the state
it is left in and the tokens emitted. No entry holds a space after another
character, so after such a place the map no longer depends on where it began:
what precedes the first such place is kept as a head to be run from the incoming
state, the rest is constant. Maps compose associatively and a prefix scan over a
text's chunks gives its count.

Results by case: a null or empty text has no tokens; an extra column is ignored;
repeated rows give repeated rows; a null id stays null.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
# Memory of a worker: what is compiled or remembered is dropped beyond these sizes.
MOST_STATES = 400_000
MOST_PAIRS = 500_000
MOST_SEGMENTS = 500_000
SHORT = 24  # characters of a segment that is remembered

SPACE = "▁"
_SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_RESET = re.compile(f"(?<=[^{SPACE}]){SPACE}")
_START = 0
_UNKNOWN = -1  # the last token is a character spelt in bytes, which joins nothing


class Map(NamedTuple):
    """What a chunk does to a state: run the head, then the constant rest.

    ``end`` is None while the chunk is all head.
    """

    head: str
    emitted: int
    end: int | None


class _Emitted(dict):
    """Tokens emitted by whole segments, which all begin in the start state."""

    def __init__(self, transducer: Transducer) -> None:
        super().__init__()
        self.transducer = transducer

    def __missing__(self, segment: str) -> int:
        emitted = self.transducer.run(_START, segment)[1]
        if len(segment) <= SHORT:
            self[segment] = emitted
        return emitted


class Transducer:
    """The compiled vocabulary; states and transitions are made when first met."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        self.scores = dict(pieces)
        if any(_RESET.search(piece) for piece in self.scores):
            raise ValueError("an entry holds a space after another character")
        # Prefixes that some longer entry continues.
        self.open = {piece[:n] for piece in self.scores for n in range(1, len(piece))}
        self.whole: dict[str, bool] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self._forget()

    def _forget(self) -> None:
        # A state: whether its last character is a space, then for each live place
        # (text since, last token there, tokens ended since).
        start = (True, (("", None, 0),))
        self.states = [start]
        self.numbers = {start: _START}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.segments = _Emitted(self)

    def trim(self) -> None:
        """Bound the memory, between texts."""
        if len(self.states) > MOST_STATES or len(self.segments) > MOST_SEGMENTS:
            self._forget()
        if len(self.pairs) > MOST_PAIRS:
            self.pairs, self.whole = {}, {}

    def merged(self, text: str) -> list[str]:
        """The text's tokens by repeated merging, best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _may_follow(self, last: str | int | None, token: str) -> bool:
        if last is None or last == _UNKNOWN:
            if token not in self.whole:
                self.whole[token] = self.merged(token) == [token]
            return self.whole[token]
        pair = (last, token)
        if pair not in self.pairs:
            self.pairs[pair] = self.merged(last + token) == [last, token]
        return self.pairs[pair]

    def _number(self, state) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return number

    def _move(self, number: int, char: str) -> tuple[int, int]:
        spaced, places = self.states[number]
        if char == SPACE and not spaced:
            return self.step(_START, char)
        last, change = _UNKNOWN, len(char.encode())
        for since, before, ended in places:
            token = since + char
            if token in self.scores and self._may_follow(before, token):
                last, change = token, 1 - ended
                break
        live = [
            (since + char, before, ended + change)
            for since, before, ended in places
            if since + char in self.open
        ]
        live.append(("", last, 0))
        return self._number((char == SPACE, tuple(live))), change

    def step(self, number: int, char: str) -> tuple[int, int]:
        """The next state and the change of the token count."""
        move = self.moves[number].get(char)
        if move is None:
            move = self.moves[number][char] = self._move(number, char)
        return move

    def run(self, number: int, text: str) -> tuple[int, int]:
        """The state after a text, and the tokens emitted on the way."""
        emitted, moves = 0, self.moves
        for char in text:
            move = moves[number].get(char)
            if move is None:
                move = self.step(number, char)
            number, change = move
            emitted += change
        return number, emitted

    def chunk(self, text: str) -> Map:
        """The state map of a chunk."""
        reset = _RESET.search(text)
        if reset is None:
            return Map(text, 0, None)
        *whole, last = _SEGMENT.findall(text, reset.start())
        end, change = self.run(_START, last)
        return Map(text[: reset.start()], sum(map(self.segments.__getitem__, whole), change), end)

    def compose(self, left: Map, right: Map) -> Map:
        """First left, then right; associative."""
        if left.end is None:
            return Map(left.head + right.head, right.emitted, right.end)
        state, change = self.run(left.end, right.head)
        emitted = left.emitted + change + right.emitted
        return Map(left.head, emitted, state if right.end is None else right.end)

    def count(self, text: str, size: int = CHUNK) -> int:
        """The number of tokens of a text already in the vocabulary's alphabet."""
        maps = [Map("", 0, _START)]
        maps += [self.chunk(text[i : i + size]) for i in range(0, len(text), size)]
        return prefix_scan(maps, self.compose)[-1].emitted


def prefix_scan(items: list, compose: Callable) -> list:
    """All prefixes' compositions in as many rounds as the length has bits."""
    items, reach = list(items), 1
    while reach < len(items):
        items = items[:reach] + [
            compose(items[i - reach], items[i]) for i in range(reach, len(items))
        ]
        reach *= 2
    return items


@cache
def _compiled(path: str) -> Transducer:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))
    ]
    return Transducer(kept)


def count_text(path: str, text: str | None) -> int:
    """Tokens of one text: spaces are marked and one is put in front."""
    if not text:
        return 0
    transducer = _compiled(path)
    count = transducer.count(SPACE + text.replace(" ", SPACE))
    transducer.trim()
    return count


def token_count(text: Column, model: str) -> Column:
    """The number of tokens of a text column under the model file ``model``."""

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((count_text(model, text.as_py()) for text in batch), pa.int64())

    return counted(text)


def token_counts(
    documents: DataFrame, model: str, limit: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Key, UTF-8 bytes, tokens, and whether the tokens exceed ``limit``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    counted = documents.select(
        F.col(key), F.octet_length(whole).cast("long").alias("n_bytes"),
        token_count(whole, model).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
