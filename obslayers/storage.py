"""Shared folders and the few file operations that Spark's reader and writer lack.

Paths go through Hadoop's ``FileSystem``, so they may live on any storage the
cluster can reach.
"""

from __future__ import annotations

import functools
import re
import tempfile
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from obslayers.session import settings

SHARED_DIR_SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@functools.cache
def _local_shared_dir() -> str:
    return tempfile.mkdtemp(prefix="obslayers-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A session whose executors are the driver itself (master ``local`` or ``local[n]``,
    as in tests) may leave it unset; it then gets a temporary folder.
    """
    configured = spark.conf.get(SHARED_DIR_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return _local_shared_dir()
    raise ValueError(f"set {SHARED_DIR_SETTING} to a folder that all executors share")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For results that several actions need: unlike a cache, the written table outlives
    lost executors and is never computed again. What the job shuffled on the way is deleted
    when it ends, since nothing reads it any more.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    for scratch in _open:
        scratch.paths.append(path)
    with settings(spark, {SHUFFLE_CLEANUP: "true"}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_open: list[Scratch] = []


@dataclass(eq=False)
class Scratch:
    """The folders that ``materialize`` writes within the block, to be deleted when nothing reads them any more."""

    spark: SparkSession
    paths: list[str] = field(default_factory=list)

    def __enter__(self) -> Scratch:
        _open.append(self)
        return self

    def __exit__(self, *_) -> None:
        _open.remove(self)

    def clear(self) -> None:
        while self.paths:
            delete(self.spark, self.paths.pop())


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, sorted; empty when it does not exist."""
    fs, target = _filesystem(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def age(spark: SparkSession, path: str) -> float:
    """Seconds since ``path`` was written."""
    fs, target = _filesystem(spark, path)
    return time.time() - fs.getFileStatus(target).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _filesystem(spark, path)
    fs.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` holding ``text``; fails when it already exists."""
    fs, target = _filesystem(spark, path)
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _filesystem(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
