"""Good and bad messages of a topic, filed apart in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obslayers.operators.verdicts import MESSAGE, REASON, REJECTED, USABLE, VERDICT, judged_messages
from obslayers.schemas import OBSERVATION
from obslayers.sources.tables import read_table
from obslayers.sources.topic import Topic, stream_topic
from obslayers.streaming.runs import UNTIL_CAUGHT_UP, start
from obslayers.streaming.sinks import claim, to_parquet

# What tells a rejected message's place in the topic.
PLACE = ("partition", "offset")


def judge_new(
    spark: SparkSession,
    topic: Topic,
    table: str,
    checkpoint: str,
    starting: str = "earliest",
    since: str | None = None,
    every: str | None = UNTIL_CAUGHT_UP,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
    wind_in_kmh: bool = True,
) -> StreamingQuery:
    """Append what the topic gained to ``table``, filed by verdict.

    Each message is read and decoded once and written once, to the folder of usable or to
    that of rejected ones, by one sink; so both are complete after any restart.
    """
    records = stream_topic(spark, topic, starting, since, per_trigger, min_partitions)
    text = records.select(*PLACE, F.col("value").cast("string").alias("json"))
    claim(spark, table, checkpoint)
    writer = to_parquet(judged_messages(text, PLACE, wind_in_kmh=wind_in_kmh), table, [VERDICT])
    return start(spark, writer, every=every, checkpoint=checkpoint)


def usable_observations(spark: SparkSession, table: str) -> DataFrame:
    """The clean observations of a judged table; only their folder is read."""
    rows = read_table(spark, table).where(F.col(VERDICT) == USABLE)
    return rows.drop(VERDICT, REASON, MESSAGE, *PLACE)


def rejected_messages(spark: SparkSession, table: str) -> DataFrame:
    """The rejected messages with their place in the topic and the reason; only their folder is read."""
    return read_table(spark, table).where(F.col(VERDICT) == REJECTED).select(*PLACE, REASON, MESSAGE)


def rejection_counts(spark: SparkSession, table: str) -> DataFrame:
    """How many messages were rejected for each reason."""
    return rejected_messages(spark, table).groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))
