"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Hours and window bounds are taken in this zone, whatever the cluster's is.
ZONE = "UTC"


def builder(app_name: str) -> SparkSession.Builder:
    """Settings a submitted job wants; sizes stay with the cluster's defaults."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Sessions of one task merge before they are shuffled to their user.
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )


def pin_zone(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", ZONE)
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="riskstream-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a ``local`` master, whose executors are the driver itself, may fall
    back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local["):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def shared_path(spark: SparkSession, path: str) -> str:
    """The path in full; refused where executors would each write to a disk of their own."""
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{path} is on each machine's own disk; name a folder all share")
    return files.makeQualified(named).toString()
