"""Folders and files through Hadoop's file system of a path, so that they mean the same on a cluster's store."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir); a local one only where that is unset and
    all runs in one process, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        root = f"file://{tempfile.gettempdir()}/chronofold-core"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str) -> tuple:
    """(file system, qualified path), of Hadoop's kinds."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(target)


def create(spark: SparkSession, path: str, data: bytes) -> bool:
    """Write a whole new file; False, and nothing changed, if it exists. Of several writers one gets True.

    On a cluster's store the file is written under a name of its own and renamed, which does not replace what is there.
    The local file system's rename would replace, so there the new name is a hard link, which fails if it exists."""
    fs, target = file_system(spark, path)
    if fs.exists(target):
        return False
    fs.mkdirs(target.getParent())
    if fs.getScheme() == "file":
        name = target.toUri().getPath()
        part = f"{os.path.dirname(name)}/.{uuid.uuid4().hex}"
        with open(part, "xb") as f:
            f.write(data)
        try:
            os.link(part, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
        return True
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(part, False)
    out.write(bytearray(data))
    out.close()
    done = False
    try:
        done = fs.rename(part, target)
    finally:
        if not done:
            fs.delete(part, False)
    return done


def read(spark: SparkSession, path: str) -> bytes | None:
    """A small file's bytes; None if it is not there."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; hidden ones left out."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(n for s in fs.listStatus(target) if not (n := s.getPath().getName()).startswith("."))


def delete(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)
