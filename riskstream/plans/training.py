"""The training job: stored scores if there are any, else generated rows."""

from __future__ import annotations

import logging

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from riskstream.config import GeneratorConfig
from riskstream.functions.decision import REMOTE_LOCATION
from riskstream.operators import datagen, model
from riskstream.sources.tables import scored_table

log = logging.getLogger(__name__)

# Fixed value: how many rows to generate when nothing is stored yet.
GENERATED_ROWS = 10_000


def generated_rows(spark: SparkSession, rows: int = GENERATED_ROWS, seed: int = 42) -> DataFrame:
    """Rows over every location and category live traffic can carry.

    One partition: a forest's draws depend on how its input is split, and this
    small set backs the artifact that ships with the package.
    """
    return datagen.training_rows(
        spark.range(0, rows, numPartitions=1),
        seed,
        locations=[*GeneratorConfig.locations, REMOTE_LOCATION],
        categories=datagen.MERCHANT_CATEGORIES,
    )


def run(
    spark: SparkSession, processed_path: str, model_path: str, seed: int = model.SEED
) -> tuple[PipelineModel, float]:
    stored = scored_table(spark, processed_path)
    if stored is None:
        rows, key = generated_rows(spark, seed=seed), "id"
    else:
        rows, key = model.relabelled(stored), "transaction_id"
    fitted, auc = model.fit(rows, key, seed)
    log.info("holdout area under ROC: %.4f", auc)
    model.save(fitted, model_path)
    return fitted, auc
