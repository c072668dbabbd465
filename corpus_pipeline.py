"""Raw documents to packed training sequences, one operator after another.

Each stage takes (spark, docs, folder) and returns a frame that is written as
Parquet and read again as the next stage's docs. All but the last return the columns
of ``documents``:

1. quality rules: documents that they reject go;
2. near-duplicates: of each component the document with the least id stays;
3. repeated passages: a passage stays in the document with the least id that has it and
   is cut from the others; a document of which no word is left goes;
4. mixing: documents are repeated until the languages have their target shares of the
   words, and none is dropped;
5. packing: the pieces of all documents, in sequences.

Rows that repeat an id: stage 2 keeps one row of the id. An empty table gives an empty
table in each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskstream.llm import mixing, packing, passages, quality_rules, set_sketch
from riskstream.llm.common import Scratch, table
from riskstream.llm.queries import TARGETS, tokenizer


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    field = quality_rules.learn(docs, table(spark, folder, "labels"))
    return quality_rules.kept_documents(docs, field)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return set_sketch.first_of_each(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return passages.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    mixed = mixing.mixed(
        docs, table(spark, folder, "labels"), TARGETS, Scratch(spark, "mixing"),
        least=1.0, thin=False,
    )
    return mixing.mix_documents(docs, mixed)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.packed(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mix),
    ("packing", pack),
]

# Learnt models and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, folder), name)
    return docs
