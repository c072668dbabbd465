"""One query for each operator, over its whole table, and its SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.llm import (
    bpe,
    conversation_repair,
    licences,
    mixing,
    packing,
    passages,
    prefix_trie,
    quality_classifier,
    quality_rules,
    set_sketch,
    token_counts,
    toxicity,
    vector_index,
)
from riskstream.llm.common import Scratch, table

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _REGISTRY[build.__name__] = build
    return build


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_SQL: dict[str, str] = {
    # All pairs that share a shingle, then all that links reach.
    "op6_minhash_near_dedup": """WITH RECURSIVE
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)""",
}


def tokenizer(name: str) -> str:
    """A public tokenizer's file, which every executor has at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_quality_rules(spark, folder):
    docs = table(spark, folder, "documents")
    return quality_rules.quality_rules(
        docs, quality_rules.learn(docs, table(spark, folder, "labels"))
    )


@_query
def op2_token_counts(spark, folder):
    return token_counts.token_counts(
        table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model")
    )


def _ratings(labels: DataFrame) -> DataFrame:
    """Grades of the labelled documents: 0 poor, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    known = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    return labels.select("doc_id", F.when(known, grade).alias("grade"))


@_query
def op3_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents")
    model = quality_classifier.learn(docs, _ratings(table(spark, folder, "labels")))
    return quality_classifier.quality_grades(docs, model)


@_query
def op4_best_fit_packing(spark, folder):
    return packing.packed(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


# Wanted share of each language's words.
TARGETS = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}


@_query
def op5_soft_mixing(spark, folder):
    return mixing.mixed(
        table(spark, folder, "documents"), table(spark, folder, "labels"), TARGETS,
        Scratch(spark, "mixing"),
    )


@_query
def op6_minhash_near_dedup(spark, folder):
    return set_sketch.near_duplicates(table(spark, folder, "documents"), words=2)


@_query
def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    return toxicity.toxicity(docs, toxicity.learn(docs, table(spark, folder, "labels")))


@_query
def op8_licence_scan(spark, folder):
    """Documents as files of the directories source / language; without an id, by their text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("_"), F.sha2("text", 256)))
    place = [F.coalesce(F.col(c).cast("string"), F.lit("_")) for c in ("source", "lang")]
    files = table(spark, folder, "documents").select(
        "doc_id", F.concat_ws("/", *place, F.coalesce(name, F.lit("_"))).alias("path"), "text"
    )
    return licences.licences(files, keep=("doc_id",))


@_query
def op9_substring_dedup(spark, folder):
    return passages.repeated_passages(table(spark, folder, "documents"))


@_query
def op10_nearest_neighbours(spark, folder):
    return vector_index.nearest(
        table(spark, folder, "embeddings"), asked=F.col("vec_id") % 20 == 0
    )


@_query
def op11_conversation_repair(spark, folder):
    rows = conversation_repair.damaged(table(spark, folder, "conversations"))
    return conversation_repair.repair_conversations(rows, Scratch(spark, "repair"))


@_query
def op12_prefix_trie(spark, folder):
    scratch = Scratch(spark, "trie")
    turns, members = prefix_trie.rebuilt(table(spark, folder, "conversations"), scratch)
    return prefix_trie.prefix_trie(turns, members, scratch)


@_query
def op13_bpe_round_trip(spark, folder):
    return bpe.round_trip(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))
