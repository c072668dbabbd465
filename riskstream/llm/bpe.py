"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

The automaton accepts exactly the token sequences that byte-pair encoding produces.
It starts as one state with a loop for each byte. Each merge (u, v) -> w, in order,
adds a gadget: wherever an arc u is followed by an arc v, an arc w leads past both,
and u now leads to a copy of its state that lacks v. All arcs of one token lead to
one state, which is therefore written (token, time): the state that the token's arcs
led to after so many merges. A copy shares what it does not change with its original,
so a merge takes constant room and no table of states by tokens is ever laid out.

Encoding reads bytes. A row of the byte table stands for all places of a word at
which a token that is not yet complete may have begun, each with its automaton state
there. Since the automaton accepts one sequence for each word, one token at most ends
at a byte: the table gives the next row and that token, and the tokens of the word
are read off from its end. Rows are made when first met and kept; words too. Both are
dropped beyond a fixed size, so a worker's memory does not grow with the texts.

A text is first cut at special tokens and split into words as the tokenizer's
file says. Ids are decoded by joining the labels of their arcs; bytes that are no
UTF-8 become the replacement character.

Results by case: a null or empty text has no tokens and decodes to the empty text; a
null list of ids decodes to null; repeated rows are encoded alike; extra columns are
left out of the digests; an empty table gives an empty table.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Memory of a worker: rows of the byte table, pairs of tokens, letters of remembered words.
MOST_ROWS = 200_000
MOST_PAIRS = 500_000
MOST_LETTERS = 8_000_000
LONGEST = 64  # longer words are not remembered
PART = 100_000  # words encoded at once
WHOLE = 1_000_000  # letters of a text whose words are listed at once

# How the file's byte-level splitter cuts a text (a fixed value), and the characters whose
# classes do not depend on the Unicode version: texts with others are cut by the library.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
UNSETTLED = regex.compile(
    "[^\0-ԤḀ-ỿ -⁤₠-₹℀-⏿─-⯿　-ヿ"
    "一-鼀가-힣︀-️！-ﾾ\U0001f300-\U0001f64f]"
)

_START = -1  # the state before any token
_TOKEN = (1 << 24) - 1  # an entry of the byte table: the next row above, the token below
_DIGEST = pa.struct(
    [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)
_DIGEST_SQL = "struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>"


def _alphabet() -> dict[str, int]:
    """The characters that stand for bytes: printable ones for themselves, then from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """The tokenization automaton of a list of merges, over token ids."""

    def __init__(self, size: int, merges: list[tuple[int, int, int]], base: list[int]) -> None:
        # For each token: when its merge came (0: a byte) and its two halves.
        self.born = [0] * size
        self.left = [0] * size
        self.right = [0] * size
        self.lives = [False] * size
        self.cut: dict[tuple[int, int], int] = {}  # when the state of u lost its arc v
        for token in base:
            self.lives[token] = True
        for time, (u, v, w) in enumerate(merges, 1):
            if self.lives[w]:
                raise ValueError(f"token {w} has two merges")
            # No arc v after u: the merge never applies and w has no arc.
            if not (self.lives[u] and self.lives[v] and self.carries(u, time - 1, v)):
                continue
            self.born[w], self.left[w], self.right[w], self.lives[w] = time, u, v, True
            self.cut[u, v] = time

    def carries(self, token: int, time: int, arc: int) -> bool:
        """Whether the state ``(token, time)`` has an arc ``arc``."""
        born, cut = self.born, self.cut
        while True:
            lost = cut.get((token, arc))
            if lost is not None and lost <= time:
                return False
            if born[token] > born[arc]:
                # The state began as the one of the token's right half just before.
                time, token = born[token] - 1, self.right[token]
            elif born[arc]:
                # The arc came to all states that had its left half's arc.
                time, arc = min(time, born[arc]), self.left[arc]
            else:
                return True

    def follows(self, last: int, token: int) -> bool:
        """Whether ``token`` may come after ``last`` in the finished automaton."""
        if not self.lives[token]:
            return False
        return last == _START or self.carries(last, len(self.born), token)


class Tokenizer:
    """Encoder and decoder of a byte-level tokenizer file."""

    def __init__(self, path: str) -> None:
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, splitter = described["model"], described["pre_tokenizer"]
        plain = (
            model["type"] == "BPE" and splitter["type"] == "ByteLevel" and splitter["use_regex"]
            and not splitter["add_prefix_space"] and not described["normalizer"]
            and not described["post_processor"] and not model.get("ignore_merges")
        )
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        if not plain or any(
            t[flag] for t in described["added_tokens"]
            for flag in ("single_word", "lstrip", "rstrip", "normalized")
        ):
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        byte = _alphabet()
        ids = model["vocab"]
        size = 1 + max(*ids.values(), *special.values(), -1)
        self.labels = [b""] * size
        for token, i in ids.items():
            self.labels[i] = bytes(map(byte.__getitem__, token))
        for token, i in special.items():
            self.labels[i] = token.encode()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        numbers = [(ids[u], ids[v], ids[u + v]) for u, v in merges]
        self.automaton = Automaton(size, numbers, [ids[c] for c in byte])
        self.special = special
        found = sorted(special, key=len, reverse=True)
        self.cutter = regex.compile("|".join(map(regex.escape, found))) if found else None
        # Beginnings of labels, by node and byte; and the token that a node completes.
        self.nodes: dict[int, int] = {}
        complete = {}
        for i in set(ids.values()):
            node = 0
            for b in self.labels[i]:
                node = self.nodes.setdefault(node << 8 | b, len(self.nodes) + 1)
            complete[node] = i
        self.complete = [complete.get(node, -1) for node in range(len(self.nodes) + 1)]
        self.sizes = list(map(len, self.labels))
        # The same for many ids at once: labels end to end, and decimals with their comma.
        self.lengths = np.array(self.sizes, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.joined = np.frombuffer(b"".join(self.labels), np.uint8)
        width = len(str(size)) + 1
        listed = "".join(f"{i},".ljust(width, "\0") for i in range(size)).encode()
        self.decimals = np.frombuffer(listed, np.uint8).reshape(size, width)
        # Words remembered last, and those before them; ids as native 32-bit numbers.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.letters = 0
        self._forget()

    def _forget(self) -> None:
        start = ((0, _START),)
        self.rows = [start]
        self.numbers = {start: 0}
        self.table: dict[int, int] = {}  # by row and byte
        self.pairs: dict[int, bool] = {}  # whether a token may follow another

    def _follows(self, last: int, token: int) -> bool:
        pair = last << 24 | token
        known = self.pairs.get(pair)
        if known is None:
            known = self.pairs[pair] = self.automaton.follows(last, token)
        return known

    def _transition(self, row: int, byte: int) -> int:
        """The next row, and the token that ends with this byte."""
        token, live = -1, []
        nodes, complete = self.nodes, self.complete
        for place in self.rows[row]:
            node, last = place
            after = nodes.get(node << 8 | byte)
            if after is not None:
                live.append((after, last))
                if token < 0:
                    ended = complete[after]
                    if ended >= 0 and self._follows(last, ended):
                        token = ended
        live.append((0, token))
        key = tuple(live)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.rows)
            self.rows.append(key)
        move = self.table[row << 8 | byte] = number << 24 | token
        return move

    def _word(self, word: str) -> bytes:
        """The ids of a word."""
        if len(self.rows) > MOST_ROWS or len(self.pairs) > MOST_PAIRS:
            self._forget()
        table, row, ends = self.table, 0, []
        raw = word.encode()
        for byte in raw:
            move = table.get(row << 8 | byte) or self._transition(row, byte)
            row = move >> 24
            ends.append(move & _TOKEN)
        ids, at = array("I"), len(raw)
        while at:
            token = ends[at - 1]
            ids.append(token)
            at -= self.sizes[token]
        ids.reverse()
        return ids.tobytes()

    def _ids(self, word: str) -> bytes:
        """The ids of a word, remembered or not."""
        known = self.words.get(word) or self.older.get(word) or self._word(word)
        if len(word) <= LONGEST:
            self.words[word] = known
            self.letters += len(word) + 8
            if self.letters > MOST_LETTERS:
                self.older, self.words, self.letters = self.words, {}, 0
        return known

    def _split(self, text: str) -> Iterator[str]:
        if UNSETTLED.search(text):
            spans = self.library.pre_tokenizer.pre_tokenize_str(text)
            return (text[start:stop] for _, (start, stop) in spans)
        if len(text) <= WHOLE:
            return iter(SPLIT.findall(text))
        return (found.group() for found in SPLIT.finditer(text))

    def _pieces(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Texts between special tokens, and those tokens' ids."""
        at = 0
        for found in self.cutter.finditer(text) if self.cutter else ():
            yield text[at : found.start()], self.special[found.group()]
            at = found.end()
        yield text[at:], None

    def parts(self, text: str | None) -> Iterator[np.ndarray]:
        """The ids of a text, some words at a time."""
        for piece, special in self._pieces(text or ""):
            words = self._split(piece)
            while some := list(islice(words, PART)):
                known = list(map(self.words.get, some))
                if None in known:
                    known = [ids or self._ids(w) for ids, w in zip(known, some, strict=True)]
                yield np.frombuffer(b"".join(known), np.uint32)
            if special is not None:
                yield np.array([special], np.uint32)

    def encode(self, text: str | None) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint32), *self.parts(text)])

    def spelt(self, ids: np.ndarray) -> bytes:
        """The labels of the ids' arcs, joined; an id without an arc has none."""
        ids = ids[(ids >= 0) & (ids < len(self.labels))]
        lengths = self.lengths[ids]
        begins = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum())) + np.repeat(self.starts[ids] - begins, lengths)
        return self.joined[at].tobytes()

    def decode(self, ids) -> str:
        return self.spelt(np.asarray(ids, np.int64)).decode("utf-8", "replace")

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, and digests of them in decimal and of what they decode to."""
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for part in self.parts(text):
            digits = self.decimals[part].ravel()
            listed = digits[digits != 0].tobytes()[:-1]
            ids.update(b"," + listed if n else listed)
            n += len(part)
            decoded.update(reader.decode(self.spelt(part)).encode())
        decoded.update(reader.decode(b"", True).encode())
        return n, ids.hexdigest(), decoded.hexdigest()


@lru_cache(maxsize=1)
def compiled(path: str) -> Tokenizer:
    return Tokenizer(path)


def encoded(text: Column, tokenizer: str) -> Column:
    """The ids of a text column under the tokenizer file ``tokenizer``."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = compiled(tokenizer)
        for batch in batches:
            found = [own.encode(text.as_py()).astype(np.int32) for text in batch]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            yield pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *found]))

    return ids(text)


def decoded(ids: Column, tokenizer: str) -> Column:
    """The text of a column of ids."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = compiled(tokenizer)
        for batch in batches:
            yield pa.array(
                (own.decode(list_.as_py()) if list_.is_valid else None for list_ in batch),
                pa.string(),
            )

    return texts(ids)


def round_trip(
    documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document the number of ids and the digests of the ids and of the decoded text."""

    @F.arrow_udf(_DIGEST_SQL)
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = compiled(tokenizer)
        for batch in batches:
            found = [own.digests(text.as_py()) for text in batch]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            parts = [pa.array(c, f.type) for c, f in zip(columns, _DIGEST, strict=True)]
            yield pa.StructArray.from_arrays(parts, fields=list(_DIGEST))

    return documents.select(F.col(key), digests(F.col(text)).alias("found")).select(key, "found.*")
