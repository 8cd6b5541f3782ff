"""What a stream still holds, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslayers.operators.aggregates import DAILY_MEASURES
from obslayers.schemas import STATION

# The operator that keeps the groups of an aggregate.
AGGREGATE = "stateStoreSave"


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of the stream with this checkpoint, their partitions and batches."""
    return spark.read.format("state-metadata").load(checkpoint)


def held_windows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Windows that a stream of ``windowed_averages`` holds, with what their averages are by now.

    As of ``batch``, else of the last one that was committed; the stream may be running. In
    append mode these are the windows nobody has been shown yet: after a restart they go
    on from here. Every state partition is read by its own task. Raises ValueError where
    the checkpoint is not one of such a stream.
    """
    found = [row.operatorId for row in state_operators(spark, checkpoint).where(F.col("operatorName") == AGGREGATE).collect()]
    if len(found) != 1:
        raise ValueError(f"{checkpoint} has {len(found)} aggregates, not one")
    reader = spark.read.format("statestore").option("operatorId", found[0])
    state = (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)
    # An average is held as its sum and count, in the order of the view; the names repeat there.
    parts = ", ".join(f"{name}_sum: double, {name}_count: bigint" for name in DAILY_MEASURES)
    held = state.select(
        F.col("key").cast(f"struct<{STATION}: string, window: struct<start: timestamp, end: timestamp>>").alias("key"),
        F.col("value").cast(f"struct<{parts}>").alias("value"),
    )
    averages = [
        F.try_divide(f"value.{name}_sum", f"value.{name}_count").alias(shown) for name, shown in DAILY_MEASURES.items()
    ]
    return held.select(f"key.{STATION}", F.col("key.window.start").alias("window_start"), *averages)
