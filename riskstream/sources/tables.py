"""Batch tables: what the stream stored, read back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from riskstream import schema
from riskstream.streaming.committed import CommittedTable, is_committed


def scored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored scores, or None while there are none to train on.

    Asks the file system through Spark, so it works wherever the table lives. Of a table
    with commits it takes what they name.
    """
    if is_committed(spark, path):
        stored = CommittedTable(spark, path, schema.SCORED).read()
        return None if stored.isEmpty() else stored
    try:
        stored = spark.read.schema(schema.SCORED).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if stored.isEmpty() else stored
