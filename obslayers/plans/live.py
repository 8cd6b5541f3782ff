"""Streams that print what passes, keep running totals, or archive clean rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from obslayers.functions.messages import message_text
from obslayers.operators.aggregates import TRIAL_WINDOW, running_summary, windowed_averages
from obslayers.operators.clean import SUMMARY_FIELDS, WINDOW_FIELDS, archive_observations
from obslayers.operators.counts import counted
from obslayers.schemas import EVENT_TIME, OBSERVATION, only
from obslayers.sources.topic import Topic, stream_topic
from obslayers.streaming.fanout import WindowFanOut
from obslayers.streaming.runs import start
from obslayers.streaming.sinks import claim, to_console, to_parquet

# Names of the counts that the streams take.
READ, WRITTEN = "read", "written"


def _observations(
    spark: SparkSession,
    topic: Topic,
    starting: str,
    since: str | None,
    schema: StructType,
    station_required: bool = True,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    text = message_text(stream_topic(spark, topic, starting, since, per_trigger, min_partitions))
    return archive_observations(counted(text, READ), schema=schema, station_required=station_required)


def print_messages(
    spark: SparkSession,
    topic: Topic,
    starting: str = "latest",
    since: str | None = None,
    every: str | None = None,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> StreamingQuery:
    """Print each message as it is."""
    text = message_text(stream_topic(spark, topic, starting, since, per_trigger, min_partitions), "value")
    return start(spark, to_console(text), every=every)


def print_observations(
    spark: SparkSession,
    topic: Topic,
    starting: str = "latest",
    since: str | None = None,
    every: str | None = None,
    schema: StructType = OBSERVATION,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> StreamingQuery:
    """Print each message decoded; unusable ones show as a row of nulls."""
    rows = _observations(spark, topic, starting, since, schema, False, per_trigger, min_partitions)
    return start(spark, to_console(rows), every=every)


def print_running_summary(
    spark: SparkSession,
    topic: Topic,
    starting: str = "latest",
    since: str | None = None,
    every: str | None = None,
    schema: StructType = OBSERVATION,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> StreamingQuery:
    """Print the averages of every station since the start, whole at each trigger."""
    rows = _observations(spark, topic, starting, since, only(schema, SUMMARY_FIELDS), True, per_trigger, min_partitions)
    return start(spark, to_console(running_summary(rows, unbounded_state=True)), "complete", every)


def archive(
    spark: SparkSession,
    topic: Topic,
    table: str,
    checkpoint: str,
    starting: str = "latest",
    since: str | None = None,
    every: str | None = None,
    by_day: bool = False,
    schema: StructType = OBSERVATION,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> StreamingQuery:
    """Append clean rows to a parquet table.

    ``by_day`` adds a ``reference_date`` partition column for readers that prune. Every
    micro-batch reports the messages read and the rows written (``StreamCounts``).
    """
    rows = _observations(spark, topic, starting, since, schema, True, per_trigger, min_partitions)
    if by_day:
        rows = rows.withColumn("reference_date", F.to_date(EVENT_TIME))
    rows = counted(rows, WRITTEN)
    writer = to_parquet(rows, table, ["reference_date"] if by_day else [])
    claim(spark, table, checkpoint)
    return start(spark, writer, every=every, checkpoint=checkpoint)


def archive_with_windows(
    spark: SparkSession,
    topic: Topic,
    fan_out: WindowFanOut,
    starting: str = "latest",
    since: str | None = None,
    every: str | None = None,
    schema: StructType = OBSERVATION,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> StreamingQuery:
    """Clean rows, window averages and late rows by one stream, which reads and decodes each message once.

    The sums of the windows are in a table instead of a state store, so nothing is held
    between batches, and windows may stay open for ever.
    """
    rows = _observations(spark, topic, starting, since, schema, True, per_trigger, min_partitions)
    return start_fan_out(spark, rows, fan_out, every)


def start_fan_out(spark: SparkSession, rows: DataFrame, fan_out: WindowFanOut, every: str | None = None) -> StreamingQuery:
    """Start the stream of clean ``rows`` into the tables of ``fan_out``."""
    generations = fan_out.generations(spark)

    def write(batch: DataFrame, epoch: int) -> None:
        fan_out.write(batch, epoch, generations)

    return start(spark, rows.writeStream.foreachBatch(write), every=every, checkpoint=fan_out.checkpoint)


def print_windows_and_archive(
    spark: SparkSession,
    topic: Topic,
    table: str,
    checkpoint: str,
    starting: str = "latest",
    since: str | None = None,
    every: str | None = None,
    width: str = TRIAL_WINDOW,
    watermark: str | None = None,
    schema: StructType = OBSERVATION,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two streams from the same topic: changed windows to the console, clean rows to a table.

    Each reads the topic itself. Without a watermark the windows' state never expires.
    """
    rows = _observations(spark, topic, starting, since, schema, True, per_trigger, min_partitions)
    narrow = only(schema, WINDOW_FIELDS)
    averaged = _observations(spark, topic, starting, since, narrow, True, per_trigger, min_partitions)
    windows = windowed_averages(averaged, width, watermark, unbounded_state=watermark is None)
    claim(spark, table, checkpoint)
    printed = start(spark, to_console(windows), "update", every)
    archived = start(spark, to_parquet(rows, table), every=every, checkpoint=checkpoint)
    return printed, archived
