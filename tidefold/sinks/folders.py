"""Shared folders of a job, through Hadoop's file system API so that any store works."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir.

    Only a session that runs in one process has a local temporary folder where that is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _local_folder(spark.sparkContext.master)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@lru_cache(maxsize=1)
def _temporary() -> str:
    return tempfile.mkdtemp(prefix="tidefold-")


def _local_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _temporary()


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, none where it is missing."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, p = _file_system(spark, path)
    return fs.getContentSummary(p).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


# what a query shuffles leaves the disk when the query ends, not when the driver happens to collect its garbage
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT = "spark.sql.files.maxPartitionBytes"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
