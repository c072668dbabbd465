"""The forest: fitting, judging, saving and loading it."""

from __future__ import annotations

import hashlib
import os
import uuid
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream import schema
from riskstream.functions.labels import relabel, split_bucket
from riskstream.session import shared_folder

# Forest size, split and seed.
TREES = 20
DEPTH = 5
BINS = 32
TRAIN_PERCENT = 80
SEED = 42

CATEGORY_INDEXES = [f"{name}_idx" for name in schema.CATEGORY_INPUTS]
FEATURE_ORDER = schema.NUMERIC_INPUTS + CATEGORY_INDEXES


def indexer() -> StringIndexer:
    """Ordinals by falling frequency; unseen and null share one more bucket.

    One indexer covers both categories, so their counts take one pass.
    """
    return StringIndexer(
        inputCols=schema.CATEGORY_INPUTS,
        outputCols=CATEGORY_INDEXES,
        stringOrderType="frequencyDesc",
        handleInvalid="keep",
    )


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURE_ORDER, outputCol="features")


def forest(bins: int = BINS, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="label",
        featuresCol="features",
        numTrees=TREES,
        maxDepth=DEPTH,
        maxBins=bins,
        seed=seed,
    )


def fit_stages(rows: DataFrame, seed: int = SEED) -> PipelineModel:
    """Indexer, assembler and forest; a category may have more labels than ``BINS``."""
    indexed = indexer().fit(rows)
    labels = max(len(found) for found in indexed.labelsArray)
    prepared = assembler().transform(indexed.transform(rows))
    # Two classes are known beforehand; without saying so the fit looks for the largest.
    two = {"ml_attr": {"type": "nominal", "vals": ["0", "1"], "name": "label"}}
    prepared = prepared.select(
        "features", F.col("label").cast("double").alias("label", metadata=two)
    )
    fitted = forest(max(BINS, labels + 1), seed).fit(prepared)
    return PipelineModel(stages=[indexed, assembler(), fitted])


def with_split(rows: DataFrame, key: str) -> DataFrame:
    """Mark the training side by a hash of the key: a filter, not a sample.

    Both sides stay pure filters over the input, agree after a retry and do
    not depend on partitioning.
    """
    whole = isinstance(rows.schema[key].dataType, T.IntegralType)
    number = F.col(key) if whole else F.xxhash64(key)
    bucket = split_bucket(number)
    return rows.withColumns({"bucket": bucket, "is_train": bucket < TRAIN_PERCENT})


def relabelled(scored: DataFrame) -> DataFrame:
    """Stored scores as training rows: raw inputs and a label, nothing else.

    Dropping the stored probability and class keeps them from clashing with
    the columns the next fit adds.
    """
    return scored.select(
        "transaction_id",
        *schema.MODEL_INPUTS,
        relabel(F.col("risk_level")).alias("label"),
    )


def fit(rows: DataFrame, key: str, seed: int = SEED) -> tuple[PipelineModel, float]:
    """Fit on the training side; return the model and its holdout AUC."""
    columns = [*schema.MODEL_INPUTS, "label"]
    split = with_split(rows, key)
    model = fit_stages(split.where("is_train").select(columns), seed)
    holdout = split.where("NOT is_train").select(columns)
    return model, area_under_roc(model.transform(holdout).select("rawPrediction", "label"))


def area_under_roc(predictions: DataFrame, score: str = "rawPrediction") -> float:
    """Exact area: one point per distinct score, reduced map side."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol="label", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(predictions)


# Ranges of scores that are put in order each by itself.
RANGES = 4096


def rank_sum_area(predictions: DataFrame, score: Column) -> float:
    """The area from ranks: how often a positive outscores a negative, ties half.

    Rows are reduced to one per distinct score. These are put in order within ranges of
    1/4096 of a probability; what lies below a range is a sum over the ranges, of which
    probabilities have no more than that whatever the rows. No task orders all scores.
    """
    scores = predictions.groupBy(score.alias("score")).agg(
        F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no")
    )
    scores = scores.withColumn("range", F.floor(F.col("score") * RANGES))
    ranges = scores.groupBy("range").agg(F.sum("no").alias("no"))
    lower = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("range", F.coalesce(F.sum("no").over(lower), F.lit(0)).alias("lower"))
    below = Window.partitionBy("range").orderBy("score").rowsBetween(
        Window.unboundedPreceding, -1
    )
    outscored = F.coalesce(F.sum("no").over(below), F.lit(0)) + F.col("no") / 2
    wins, yes, no = (
        scores.withColumn("outscored", outscored)
        .join(ranges, "range")
        .agg(
            F.sum(F.col("yes") * (F.col("outscored") + F.col("lower"))), F.sum("yes"), F.sum("no")
        )
        .first()
    )
    return wins / (yes * no)


def category_index(rows: DataFrame) -> DataFrame:
    """The ordinals as a table, ``field, label, idx``, as the indexer would fit them."""
    fields = F.explode(
        F.array(
            *[F.struct(F.lit(f).alias("field"), F.col(f).alias("label")) for f in schema.CATEGORY_INPUTS]
        )
    )
    counts = (
        rows.select(fields.alias("f")).select("f.*").where("label is not null")
        .groupBy("field", "label").count()
    )
    order = Window.partitionBy("field").orderBy(F.desc("count"), "label")
    return counts.select(
        "field", "label", (F.row_number().over(order) - 1).cast("double").alias("idx")
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """A missing or broken artifact is an error here, not a silent exit."""
    return PipelineModel.load(path)


def _artifact_digest(folder: str) -> str:
    found = hashlib.sha256()
    for base, _, names in sorted(os.walk(folder)):
        for name in sorted(names):
            with open(os.path.join(base, name), "rb") as handle:
                found.update(name.encode() + handle.read())
    return found.hexdigest()[:16]


def publish(spark: SparkSession, folder: str) -> str:
    """Copy an artifact of this machine to the shared folder, once per content."""
    target = f"{shared_folder(spark)}/models/{_artifact_digest(folder)}"
    jvm = spark.sparkContext._jvm
    path_of = jvm.org.apache.hadoop.fs.Path
    fs = path_of(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path_of(target)):
        # Copy beside the target, then rename: readers see all of it or none.
        partial = f"{target}.{uuid.uuid4().hex}"
        fs.copyFromLocalFile(path_of(f"file://{folder}"), path_of(partial))
        if not fs.rename(path_of(partial), path_of(target)):
            fs.delete(path_of(partial), True)
    return target


PINNED = os.path.join(os.path.dirname(os.path.dirname(__file__)), "artifacts", "risk_forest")


@cache
def _pinned(spark: SparkSession, _application: str) -> PipelineModel:
    return load(publish(spark, PINNED))


def pinned(spark: SparkSession) -> PipelineModel:
    """The model shipped with the package, loaded once per application."""
    return _pinned(spark, spark.sparkContext.applicationId)
