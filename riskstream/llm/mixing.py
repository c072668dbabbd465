"""Mixing to target weights with soft memberships, by DataFrame functions alone.

A naive Bayes classifier over hashed words is counted from labelled documents whose
domain is known, at most ``SAMPLE`` of them. It gives every document a posterior over
the domains. Each document then gets a rate: how many times it is wanted in the mix.
The rates are the nonnegative least-squares fit of expected domain totals,

    sum over documents of rate * words * posterior,

to the targets, each error relative to the domain's present share, with a small pull
towards one. Projected gradient steps are taken on all documents at once: since a
step's direction is the posterior times one number for each domain, a rate is an
expression of those few numbers, and an iteration is one aggregation over a table of
posteriors that brings back one number for each domain. In the metric of the documents'
words the step length one always descends.

Results by case: a text without words, or null, has the prior as posterior and counts
nothing; rows that share an id, or lack one, are one document to the classifier and
have one rate; a domain without labelled documents or words keeps the others' fit; with
no labelled document at all every domain is as likely; extra columns are ignored; an
empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import Scratch

BUCKETS = 4096
SAMPLE = 4000  # labelled documents that teach the classifier
SMOOTHING = 0.5
# Words beyond these add no confidence: words of a text aren't independent.
EVIDENCE = 50
PULL = 1e-3
STEPS = 25
CLOSE = 1e-6

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def _words(documents: DataFrame, text: str, *kept: Column) -> DataFrame:
    """One row for each word and its bucket; a text without words has one without."""
    words = F.explode(F.split(F.coalesce(F.col(text), F.lit("")), WHITE_SPACE)).alias("word")
    bucket = F.when(F.col("word") != "", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)))
    return documents.select(*kept, words).select("*", bucket.alias("bucket")).drop("word")


class Classifier:
    """Word weights, a table of ``BUCKETS`` rows, and log priors, by domain."""

    def __init__(self, domains: list[str], weights: DataFrame, priors: list[float]) -> None:
        self.domains, self.weights, self.priors = domains, weights, priors


def learn(
    documents: DataFrame, labels: DataFrame, domains: list[str], scratch: Scratch,
    domain: str = "lang", key: str = "doc_id", text: str = "text", sample: int = SAMPLE,
) -> Classifier:
    """Count the classifier from documents that ``labels`` names and whose domain is known."""
    chosen = (
        labels.select(F.col(key).alias("id")).where("id is not null").distinct()
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    taught = documents.select(
        F.col(key).alias("id"), F.col(domain).alias("domain"), F.col(text).alias("text")
    ).where(F.col("domain").isin(domains)).join(F.broadcast(chosen), "id")
    by_domain = [(F.col("domain") == d).cast("long") for d in domains]
    counts = scratch.keep(
        _words(taught, "text", *[flag.alias(f"c{k}") for k, flag in enumerate(by_domain)])
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(len(domains))]),
        "counts",
    )
    totals = counts.agg(*[F.coalesce(F.sum(f"c{k}"), F.lit(0)) for k in range(len(domains))])
    totals = totals.first()
    seen = taught.agg(*[F.coalesce(F.sum(flag), F.lit(0)) for flag in by_domain]).first()
    spark = documents.sparkSession
    weights = spark.range(BUCKETS).withColumnRenamed("id", "bucket").join(
        counts, "bucket", "left"
    )
    weights = scratch.keep(
        weights.select(
            "bucket",
            *[
                F.log(
                    (F.coalesce(f"c{k}", F.lit(0)) + SMOOTHING) / (total + SMOOTHING * BUCKETS)
                ).alias(f"w{k}")
                for k, total in enumerate(totals)
            ],
        ),
        "weights",
    )
    priors = [math.log((n + 1) / (sum(seen) + len(domains))) for n in seen]
    return Classifier(domains, weights, priors)


def posteriors(
    documents: DataFrame, classifier: Classifier, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """id, ``n_words``, and ``p0`` ... in the order of the domains; one row for each id."""
    number = range(len(classifier.domains))
    scored = (
        _words(documents, text, F.col(key).alias("id"))
        .join(F.broadcast(classifier.weights), "bucket", "left")
        .groupBy("id")
        .agg(F.count("bucket").alias("n_words"), *[F.sum(f"w{k}").alias(f"s{k}") for k in number])
    )
    weight = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.greatest("n_words", F.lit(1)))
    scored = scored.select(
        "id", "n_words",
        *[
            (F.lit(prior) + weight * F.coalesce(f"s{k}", F.lit(0.0))).alias(f"l{k}")
            for k, prior in enumerate(classifier.priors)
        ],
    )
    top = F.greatest(*[f"l{k}" for k in number]) if len(number) > 1 else F.col("l0")
    scored = scored.select(
        "id", "n_words", *[F.exp(F.col(f"l{k}") - top).alias(f"e{k}") for k in number]
    )
    total = sum((F.col(f"e{k}") for k in number), F.lit(0.0))
    return scored.select("id", "n_words", *[(F.col(f"e{k}") / total).alias(f"p{k}") for k in number])


def _rate(moves: list[list[float]], least: float) -> Column:
    """The rate after steps, of which each has one number for a domain."""
    rate = F.lit(1.0)
    for move in moves:
        pulled = (1 - PULL) * rate + PULL
        turn = sum((F.col(f"p{k}") * m for k, m in enumerate(move)), F.lit(0.0))
        rate = F.greatest(F.lit(float(least)), pulled - turn)
    return rate


def fit_rates(
    members: DataFrame, targets: list[float], least: float = 0.0, thin: bool = True
) -> Column:
    """The rate as an expression of ``p0`` ... for written posteriors ``members``.

    The wanted total is the present one, or, unless documents may be thinned, the least
    at which every domain keeps all it has.
    """
    number = range(len(targets))

    def totals(moves):
        rate = _rate(moves, least)
        sums = [
            F.coalesce(F.sum(F.col("n_words") * rate * F.col(f"p{k}")), F.lit(0.0)) for k in number
        ]
        return list(members.agg(*sums).first())

    present = totals([])
    whole = sum(present)
    if not whole:
        return F.lit(1.0)
    share = [t / sum(targets) for t in targets]
    goal = whole if thin else max(a / s for a, s in zip(present, share, strict=True) if s)
    moves: list[list[float]] = []
    now = present
    for _ in range(STEPS):
        move = [
            (now[k] - share[k] * goal) / present[k] if present[k] else 0.0 for k in number
        ]
        if max(map(abs, move)) < CLOSE:
            break
        moves.append(move)
        now = totals(moves)
    return _rate(moves, least)


def copies(rate: Column, key: str) -> Column:
    """A whole number of copies whose mean over hashed ids is the rate."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + draw).cast("int")


def mixed(
    documents: DataFrame, labels: DataFrame, targets: Mapping[str, float], scratch: Scratch,
    domain: str = "lang", least: float = 0.0, thin: bool = True,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, p_<domain> ..., rate, copies), one row for each id."""
    domains = sorted(targets)
    classifier = learn(documents, labels, domains, scratch, domain, key, text)
    members = scratch.keep(posteriors(documents, classifier, key, text), "members")
    rate = fit_rates(members, [targets[d] for d in domains], least, thin)
    return members.select(
        F.col("id").alias("doc_id"), "n_words",
        *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(domains)],
        rate.alias("rate"),
    ).withColumn("copies", copies(F.col("rate"), "doc_id"))


def mix_documents(documents: DataFrame, mix: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents, each as often as its copies, with all their columns."""
    fields = documents.columns
    rates = mix.where("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("copies").alias("__copies")
    )
    rows = documents.join(rates, F.col(key).eqNullSafe(F.col("__id")))
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return rows.select(*[documents[f] for f in fields])
