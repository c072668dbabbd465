"""The tokenization automaton against brute force and the library that owns the vocabulary."""

import hashlib
import itertools
import random

import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from riskstream.llm import bpe
from riskstream.llm.queries import op13_bpe_round_trip
from tests.conftest import TESTDATA

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(PATH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def merged(word, merges):
    """Each merge in turn, leftmost first."""
    parts = list(word)
    for u, v, w in merges:
        at = 0
        while at < len(parts) - 1:
            if parts[at] == u and parts[at + 1] == v:
                parts[at : at + 2] = [w]
            at += 1
    return parts


@pytest.mark.parametrize("seed", range(30))
def test_automaton_accepts_just_the_tokenizations(seed):
    """Random merges over two bytes, some of which never apply."""
    draw = random.Random(seed)
    spelt, merges = {0: (0,), 1: (1,)}, []
    while len(merges) < 9:
        u, v = draw.choice(list(spelt)), draw.choice(list(spelt))
        if spelt[u] + spelt[v] not in spelt.values():
            merges.append((u, v, len(spelt)))
            spelt[len(spelt)] = spelt[u] + spelt[v]
    automaton = bpe.Automaton(len(spelt), merges, [0, 1])

    def accepted(word, last):
        if not word:
            return [[]]
        return [
            [token, *rest]
            for token, labels in spelt.items()
            if word[: len(labels)] == labels and automaton.follows(last, token)
            for rest in accepted(word[len(labels) :], token)
        ]

    for size in range(1, 9):
        for word in itertools.product((0, 1), repeat=size):
            assert accepted(word, bpe._START) == [merged(word, merges)]


def test_encode_and_decode_equal_the_library(library, own):
    draw = random.Random(13)
    pool = [
        "the", "ing", "  ", "\n", "'s", "'ll", "<|endoftext|>", "<|endoftext", "123", "é", "日本",
        "\U0001F600", "aaaa", "!!", "\t", " ", "ſ", "̀", "힤", "\U0001df1f", "՘", " ", "\x1c",
    ] + list("abcdefghijklmnopqrstuvwxyz ABC")
    for _ in range(4000):
        text = "".join(draw.choice(pool) for _ in range(draw.randrange(30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_any_ids_decode_as_the_library_does(library, own):
    draw = random.Random(14)
    for _ in range(3000):
        ids = [draw.randrange(50257 if draw.random() < 0.5 else 256) for _ in range(draw.randrange(12))]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_settled_characters_split_as_the_library_does(library):
    wrong = []
    for code in range(0x110000):
        char = "" if 0xD800 <= code < 0xE000 else chr(code)
        if char and not bpe.UNSETTLED.search(char):
            text = f"a{char}1{char}!{char} x"
            spans = [span for _, span in library.pre_tokenizer.pre_tokenize_str(text)]
            if spans != [found.span() for found in bpe.SPLIT.finditer(text)]:
                wrong.append(hex(code))
    assert not wrong


def test_small_tables_give_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_ROWS", 20)
    monkeypatch.setattr(bpe, "MOST_LETTERS", 40)
    monkeypatch.setattr(bpe, "PART", 3)
    own = bpe.Tokenizer(PATH)
    text = "An unusual sentence, of 1234 words<|endoftext|>  or so.\n\n" * 5
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text).tolist() == ids
    assert own.digests(text) == (len(ids), sha(",".join(map(str, ids))), sha(text))
    assert len(own.rows) <= 40


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000, "ab" * 100_000 + "é" * 1000])
def test_long_words(library, own, text):
    ids = library.encode(text[:5000], add_special_tokens=False).ids
    assert own.encode(text[:5000]).tolist() == ids
    n, _, back = own.digests(text)
    assert n and back == sha(text)


def test_query_equals_library(spark, library):
    folder = f"{TESTDATA}/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op13_bpe_round_trip(spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids) and row.ids_sha256 == sha(",".join(map(str, ids)))
        assert row.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, 1), (1, "", 2), (None, "same", 3), (None, "same", 4), (5, "<|endoftext|>", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    found = bpe.round_trip(docs, PATH)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    empty = (0, sha(""), sha(""))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, *empty), (1, *empty), *[(None, 1, sha("31642"), sha("same"))] * 2,
         (5, 1, sha("50256"), sha("<|endoftext|>"))], key=repr,
    )
    assert bpe.round_trip(docs.limit(0), PATH).collect() == []


def test_columns_of_ids_and_texts(spark):
    docs = spark.createDataFrame([("one <|endoftext|>",), ("",), (None,)], "text string")
    ids = docs.select("text", bpe.encoded(F.col("text"), PATH).alias("ids"))
    back = ids.select("text", "ids", bpe.decoded(F.col("ids"), PATH).alias("back")).collect()
    assert [(r.text, r.back) for r in back] == [("one <|endoftext|>",) * 2, ("", ""), (None, "")]
    assert back[0].ids[-1] == 50256
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert nothing.select(bpe.decoded(F.col("ids"), PATH).alias("t")).collect()[0].t is None
