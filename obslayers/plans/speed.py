"""The live view: six-minute averages kept up to date in a keyed table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from obslayers.functions.messages import message_text
from obslayers.operators.aggregates import SPEED_WATERMARK, SPEED_WINDOW, windowed_averages
from obslayers.operators.clean import averaged_observations
from obslayers.schemas import SPEED_KEYS
from obslayers.sources.topic import Topic, stream_topic
from obslayers.streaming.keyed import KEEP_SECONDS, KeyedTable
from obslayers.streaming.runs import start
from obslayers.streaming.sinks import EPOCH_FILES, to_keyed

SPEED_INTERVAL = "1 minute"
# Micro-batches between compactions of the log, which each reader would else list whole.
COMPACT_EVERY = 60


def speed_table(path: str, keep_seconds: float = KEEP_SECONDS) -> KeyedTable:
    return KeyedTable(path, SPEED_KEYS, "window_start", keep_seconds)


def run_speed(
    spark: SparkSession,
    topic: Topic,
    target,
    checkpoint: str,
    starting: str = "latest",
    since: str | None = None,
    every: str | None = SPEED_INTERVAL,
    mode: str = "update",
    width: str = SPEED_WINDOW,
    watermark: str = SPEED_WATERMARK,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
    partitions: int | None = None,
    files: int = EPOCH_FILES,
    compact_every: int | None = COMPACT_EVERY,
    strict: bool = False,
) -> StreamingQuery:
    """Start the live view.

    In update mode a window is written whenever it changes, in append mode once,
    after the watermark has passed its end. With a new checkpoint the stream starts
    at the latest messages, so a window in progress is computed again from part of
    its rows and the newer, partial row wins. ``min_partitions`` spreads a busy Kafka partition over
    that many tasks; ``partitions`` is the number of state partitions.
    """
    records = stream_topic(spark, topic, starting, since, per_trigger, min_partitions)
    averages = windowed_averages(averaged_observations(message_text(records), strict=strict), width, watermark)
    generation = target.open_generation(spark, checkpoint)
    compacted = compact_every if hasattr(target, "compact") else None
    writer = to_keyed(averages, target, generation, files, compacted)
    return start(spark, writer, mode, every, checkpoint, partitions)
