"""Message topics: Kafka, or a folder of files with Kafka's column layout.

Both kinds are read by Spark's own sources, bounded or as a stream, so everything
behind the scan is the same.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslayers.schemas import TOPIC_RECORD

# A file source passes over files that are older than this, counted from the newest one it has
# seen. Its own default, a week, would lose copied and restored files without a word.
MAX_FILE_AGE = "36500d"
# Kafka's number for "timestamp set by the producer".
CREATE_TIME = 0


@dataclass(frozen=True)
class Topic:
    """Where messages come from: give ``servers`` for Kafka or ``folder`` for files."""

    name: str = "observations"
    servers: str | None = None
    folder: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if (self.servers is None) == (self.folder is None):
            raise ValueError("give either servers or folder")


def read_topic(spark: SparkSession, topic: Topic, min_partitions: int | None = None) -> DataFrame:
    """All messages present now, from the first to the last.

    ``min_partitions`` splits large Kafka partitions over several tasks, so a topic
    with one busy partition is not read by one task. Files split by size anyway.
    """
    if topic.folder is not None:
        return spark.read.schema(TOPIC_RECORD).options(**topic.options).parquet(topic.folder)
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", topic.servers)
        .option("subscribe", topic.name)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
    )
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.options(**topic.options).load()


def stream_topic(
    spark: SparkSession,
    topic: Topic,
    starting: str = "latest",
    since: str | None = None,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Messages as they arrive.

    ``starting`` counts for the first start only; later ones resume from the
    checkpoint. A folder has no "latest" position, so there the same effect comes
    from ``since``, a timestamp below which records are skipped. ``per_trigger``
    bounds a micro-batch: messages for Kafka, files for a folder.
    """
    if topic.folder is not None:
        reader = spark.readStream.schema(TOPIC_RECORD).option("maxFileAge", MAX_FILE_AGE).options(**topic.options)
        if per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", per_trigger)
        records = reader.parquet(topic.folder)
        if since is not None:
            return records.filter(F.col("timestamp") >= F.lit(since).cast("timestamp"))
        if starting == "latest":
            raise ValueError("a folder needs since=... to start at the latest records")
        return records
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", topic.servers)
        .option("subscribe", topic.name)
        .option("startingOffsets", starting)
    )
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.options(**topic.options).load()


def topic_records(df: DataFrame, topic: Topic, value: str = "json") -> DataFrame:
    """Messages in column ``value`` laid out as topic records.

    ``partition``, ``offset`` and ``timestamp`` are taken from ``df`` when it has them. The
    first two are else null, since positions made up here would repeat in the next call;
    the timestamp is else now.
    """
    has = set(df.columns)
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        F.col(value).cast("binary").alias("value"),
        F.lit(topic.name).alias("topic"),
        (F.col("partition") if "partition" in has else F.lit(None)).cast("int").alias("partition"),
        (F.col("offset") if "offset" in has else F.lit(None)).cast("long").alias("offset"),
        (F.col("timestamp") if "timestamp" in has else F.current_timestamp()).cast("timestamp").alias("timestamp"),
        F.lit(CREATE_TIME).alias("timestampType"),
    )


def publish(df: DataFrame, topic: Topic, value: str = "json") -> None:
    """Append messages to the topic, one per row."""
    if topic.folder is not None:
        topic_records(df, topic, value).write.mode("append").parquet(topic.folder)
        return
    (
        df.select(F.col(value).cast("string").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", topic.servers)
        .option("topic", topic.name)
        .options(**topic.options)
        .save()
    )
