"""The journals of backtests as tables, all published by one rename, or none.

Writing and renaming go through Hadoop's file system of the path, so that they mean the same on a cluster's store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronofold.errors import Conflict
from chronofold.operators.backtest import JOURNALS


def _places(spark: SparkSession, path) -> tuple:
    """(file system, path, staging path), each of Hadoop's kind."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(str(path))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    target = fs.makeQualified(target)
    return fs, target, jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.staging")


def publish(journal: DataFrame, path) -> None:
    """Write every journal below a staging folder, partitioned by its kind, and rename that to path."""
    fs, target, staging = _places(journal.sparkSession, path)
    if fs.exists(target):
        raise Conflict(f"{target} exists")
    fs.delete(staging, True)
    try:
        journal.write.partitionBy("journal").parquet(staging.toString())
        if not fs.rename(staging, target):
            raise Conflict(f"{target} cannot be published")
    except BaseException:
        fs.delete(staging, True)
        raise


def load(spark: SparkSession, path, kind: str) -> DataFrame:
    if kind not in JOURNALS:
        raise ValueError(f"no journal {kind!r}")
    _, target, _ = _places(spark, path)
    return spark.read.parquet(target.toString()).where(f"journal = '{kind}'")
