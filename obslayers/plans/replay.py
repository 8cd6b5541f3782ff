"""Readable replay of a topic from its beginning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obslayers.operators.inspect import first_by
from obslayers.operators.report import report_lines
from obslayers.sources.tables import replace_table
from obslayers.sources.topic import Topic, read_topic


def replay(spark: SparkSession, topic: Topic, min_partitions: int | None = None) -> DataFrame:
    """One line per message of all partitions."""
    return report_lines(read_topic(spark, topic, min_partitions))


def write_replay(spark: SparkSession, topic: Topic, table: str, min_partitions: int | None = None) -> None:
    """All lines into a parquet table, its files in the order of partition and offset.

    Spark cuts the order into ranges, so a busy partition of the topic is not one task.
    """
    lines = replay(spark, topic, min_partitions).select("partition", "offset", "line")
    replace_table(lines.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset"), table)


def print_replay(spark: SparkSession, topic: Topic, n: int = 20, min_partitions: int | None = None) -> None:
    """Print the first ``n`` lines in replay order, as a preview."""
    lines = first_by(replay(spark, topic, min_partitions), ("partition", "offset"), n).select("line")
    lines.show(n, truncate=False)
