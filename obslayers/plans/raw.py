"""Topic to raw table: one text column, the source of truth for the batch views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obslayers.functions.messages import message_text, present
from obslayers.sources.tables import append_table
from obslayers.sources.topic import Topic, read_topic, stream_topic
from obslayers.streaming.runs import UNTIL_CAUGHT_UP, start
from obslayers.streaming.sinks import claim, to_parquet


def raw_messages(records: DataFrame) -> DataFrame:
    """The messages of topic records as text, without empty records."""
    return present(message_text(records))


def ingest_all(spark: SparkSession, topic: Topic, table: str, min_partitions: int | None = None) -> None:
    """Append the whole topic. A second run appends it again."""
    append_table(raw_messages(read_topic(spark, topic, min_partitions)), table)


def ingest_new(
    spark: SparkSession,
    topic: Topic,
    table: str,
    checkpoint: str,
    by_day: bool = True,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
    every: str | None = UNTIL_CAUGHT_UP,
) -> StreamingQuery:
    """Append what the topic gained since the last run, each message once.

    ``by_day`` files messages under the day they reached the topic. A topic is read
    in arrival order, so that costs no shuffle and few open files.
    """
    records = stream_topic(spark, topic, "earliest", None, per_trigger, min_partitions)
    if by_day:
        day = F.to_date("timestamp").alias("ingest_date")
        rows = present(records.select(F.col("value").cast("string").alias("json"), day))
        writer = to_parquet(rows, table, ["ingest_date"])
    else:
        writer = to_parquet(raw_messages(records), table)
    claim(spark, table, checkpoint)
    return start(spark, writer, every=every, checkpoint=checkpoint)
