"""Session settings and shared folders that the operators rely on."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes that one Arrow batch may carry to a Python worker; long texts make batches heavy long before rows do.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Python workers' memory bounded. Stays set, as plans run after the operator has returned."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.pyspark.binaryAsBytes", "true")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir); a local one only where that is unset and all
    runs in one process, as in tests. On a cluster a local folder would lose rows, so there it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        root = f"file://{tempfile.gettempdir()}/chronofold-shared"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder, free the shuffle files of that job, and read it again."""
    spark = df.sparkSession
    path, key = shared_dir(spark, name), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that store() wrote, once all that is made of them is written itself."""
    for t in tables:
        dropped(t.sparkSession, t.stored_at)


def by_weight(texts: list, limit: int):
    """Ranges (from, to) of texts whose lengths add up to about limit at most; a longer text stands alone."""
    at = weight = 0
    for i, t in enumerate(texts):
        if i > at and weight + len(t) > limit:
            yield at, i
            at, weight = i, 0
        weight += len(t)
    if at < len(texts):
        yield at, len(texts)


def release() -> None:
    """Give memory that a task of a Python worker no longer uses back, as idle workers stay beside the next stage's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
