"""Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslayers import storage
from obslayers.functions.messages import json_column

STREAM_SINK_LOG = "_spark_metadata"
RAW_SCHEMA = "json string, value string"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table with the schema of its files."""
    return spark.read.parquet(path)


def require_messages(spark: SparkSession, path: str) -> None:
    """Raise ValueError where a raw table has neither message column."""
    json_column(read_table(spark, path))


def either_column(raw: DataFrame) -> DataFrame:
    """The message of each row, from the column that its file has."""
    return raw.select(F.coalesce("json", "value").alias("json"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The messages of a raw table, whichever of ``json`` and ``value`` each of its files has.

    Both columns are asked of every file, and one that lacks a column gives nulls
    there, so no schemas are gathered from the files and only message columns are read.
    """
    require_messages(spark, path)
    return either_column(spark.read.schema(RAW_SCHEMA).parquet(path))


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add the rows of ``df``; running it again adds them again.

    Refused on a folder that a streaming sink owns: readers of such a folder follow
    the sink's log and would not see files added beside it.
    """
    if storage.exists(df.sparkSession, f"{path}/{STREAM_SINK_LOG}"):
        raise ValueError(f"{path} is written by a stream; append to another folder")
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Rebuild the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def replace_days(df: DataFrame, path: str, day: str, since: str, until: str) -> None:
    """Make ``df`` the days ``since`` to ``until`` (inclusive) of the table, and leave the others.

    Days of the range for which ``df`` has no row lose the rows they had.
    """
    spark = df.sparkSession
    with storage.Scratch(spark) as scratch:
        df = storage.materialize(df, "days")
    # At most one value per day of the range.
    filled = {f"{day}={row[0]}" for row in df.select(day).distinct().collect()}
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    for name in storage.children(spark, path):
        if name.startswith(f"{day}=") and f"{day}={since}" <= name <= f"{day}={until}" and name not in filled:
            storage.delete(spark, f"{path}/{name}")
    scratch.clear()
