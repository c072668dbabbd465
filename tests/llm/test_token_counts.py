"""Counts against the library that owns the vocabulary."""

import random

import public_tokenizers
import pytest
import sentencepiece

from riskstream.llm import token_counts
from riskstream.llm.queries import op2_token_counts
from tests.conftest import TESTDATA

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_query_equals_library(spark, library):
    folder = f"{TESTDATA}/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op2_token_counts(spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        count = len(library.encode(texts[row.doc_id], num_threads=1))
        assert (row.n_tokens, row.over_limit) == (count, count > 4096)
        assert row.n_bytes == len(texts[row.doc_id].encode())


@pytest.mark.parametrize("size", [1, 2, 5, 64, 1 << 16])
def test_any_chunks_give_the_count(library, size):
    transducer = token_counts._compiled(MODEL)
    draw = random.Random(size)
    for _ in range(400):
        text = "".join(draw.choice("  aeinthrs▁\n\t.é日\U0001F600=!<s>") for _ in range(draw.randrange(1, 70)))
        marked = token_counts.SPACE + text.replace(" ", token_counts.SPACE)
        assert transducer.count(marked, size) == len(library.encode(text, num_threads=1)), text


def test_runs_of_one_character(library):
    for n in range(120):
        for text in (" " * n, " " * n + "a", "a" * n, "=" * n, "é" * n, "\U0001F600" * n):
            assert token_counts.count_text(MODEL, text) == len(library.encode(text, num_threads=1))


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_STATES", 10)
    monkeypatch.setattr(token_counts, "MOST_PAIRS", 10)
    for text in ("a text of words", "and of other words", "a text of words"):
        assert token_counts.count_text(MODEL, text) == len(library.encode(text, num_threads=1))


def test_scan_gives_every_prefix():
    for n in range(9):
        items = [str(i) for i in range(n)]
        assert token_counts.prefix_scan(items, str.__add__) == [
            "".join(items[: i + 1]) for i in range(n)
        ]


def test_nulls_empties_repeats_and_clashing_columns(spark, library):
    long = "word " * 50_000
    rows = [(1, None, 5), (1, "", 5), (None, "a b", 5), (2, "a b", 5), (2, "a b", 5), (3, long, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = [tuple(r) for r in token_counts.token_counts(docs, MODEL).collect()]
    n = len(library.encode(long, num_threads=1))
    assert sorted(found, key=str) == sorted(
        [(1, 0, 0, False), (1, 0, 0, False), (None, 3, 2, False), (2, 3, 2, False),
         (2, 3, 2, False), (3, 250_000, n, True)], key=str
    )
    assert token_counts.token_counts(docs.limit(0), MODEL).count() == 0
