"""Sums and counts of the daily view or of a view by window, written run by run and added up when read.

Below ``generation=G`` a micro-batch writes ``epoch=E/date=D``, replaced when it is
repeated. ``fold`` adds the closed epochs up to E into ``folded=E``, which counts once
it is marked as done; readers then leave those epochs out, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

from obslayers import storage
from obslayers.operators.aggregates import DAILY_MEASURES, daily_parts, window_parts
from obslayers.schemas import DAILY_KEYS, STATION
from obslayers.streaming.generations import open_generation

DONE_FILE = "_done"
SUMS = [
    field
    for name in DAILY_MEASURES
    for field in (StructField(f"{name}_sum", DoubleType()), StructField(f"{name}_count", LongType()))
]


def _numbers(names: list[str], kind: str) -> list[int]:
    return sorted(int(name.removeprefix(kind)) for name in names if name.startswith(kind))


def _write(parts: DataFrame, folder: str) -> None:
    by_day = parts.hint("rebalance", "date").write.mode("overwrite").partitionBy("date")
    by_day.option("partitionOverwriteMode", "static").parquet(folder)


@dataclass(frozen=True)
class DailyParts:
    """Parts per station and day, or with a ``window`` width per station and window; always filed by day."""

    path: str
    window: str | None = None

    @property
    def keys(self) -> tuple[str, ...]:
        return DAILY_KEYS if self.window is None else (STATION, "window_start", "date")

    @property
    def schema(self) -> StructType:
        windows = [] if self.window is None else [StructField("window_start", TimestampType())]
        return StructType([StructField(STATION, StringType()), *windows, *SUMS, StructField("date", DateType())])

    def _parts(self, observations: DataFrame) -> DataFrame:
        return daily_parts(observations) if self.window is None else window_parts(observations, self.window)

    def open_generation(self, spark: SparkSession, checkpoint: str) -> int:
        return open_generation(spark, self.path, checkpoint, "parts")

    def newest_generation(self, spark: SparkSession) -> int:
        found = _numbers(storage.children(spark, self.path), "generation=")
        if not found:
            raise ValueError(f"nothing written to {self.path} yet")
        return found[-1]

    def _home(self, generation: int) -> str:
        return f"{self.path}/generation={generation}"

    def add(self, observations: DataFrame, generation: int, epoch: int) -> list[str]:
        """Write the parts of one micro-batch; returns the days it has."""
        folder = f"{self._home(generation)}/epoch={epoch}"
        _write(self._parts(observations), folder)
        names = storage.children(observations.sparkSession, folder)
        return [name.removeprefix("date=") for name in names if name.startswith("date=")]

    def _state(self, spark: SparkSession, generation: int) -> tuple[int | None, list[int], list[str]]:
        """The last finished fold, the epochs after it, and all folder names."""
        home = self._home(generation)
        names = storage.children(spark, home)
        done = [n for n in _numbers(names, "folded=") if storage.exists(spark, f"{home}/folded={n}/{DONE_FILE}")]
        folded = done[-1] if done else None
        epochs = [
            n
            for n in _numbers(names, "epoch=")
            if (folded is None or n > folded) and storage.exists(spark, f"{home}/epoch={n}/_SUCCESS")
        ]
        return folded, epochs, names

    def _read(self, spark: SparkSession, generation: int, folded: int | None, epochs: list[int]) -> DataFrame:
        home, frames = self._home(generation), []
        if folded is not None:
            frames.append(self._files(spark, home, [f"{home}/folded={folded}"]))
        if epochs:
            frames.append(self._files(spark, home, [f"{home}/epoch={epoch}" for epoch in epochs]))
        if not frames:
            return spark.createDataFrame([], self.schema)
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def _files(self, spark: SparkSession, home: str, paths: list[str]) -> DataFrame:
        """Parts below ``paths``; an epoch without a usable message has no file at all."""
        rows = spark.read.schema(self.schema).option("basePath", home).parquet(*paths)
        return rows.select(*self.schema.fieldNames())

    def read(self, spark: SparkSession, generation: int, days: Collection[str] | None = None) -> DataFrame:
        """All parts of a generation, or those of ``days``, which prunes the folders read."""
        folded, epochs, _ = self._state(spark, generation)
        rows = self._read(spark, generation, folded, epochs)
        return rows if days is None else rows.filter(F.col("date").isin(list(days)))

    def fold(self, spark: SparkSession) -> int:
        """Add closed epochs up into one folder per day; returns how many were folded.

        The newest epoch is left, since a retry may write it again. Folders that the
        last fold replaced go now, which left their readers time to finish.
        """
        generation = self.newest_generation(spark)
        home = self._home(generation)
        folded, epochs, names = self._state(spark, generation)
        for name in names:
            kind, _, number = name.partition("=")
            stale = kind == "epoch" and folded is not None and int(number) <= folded
            if stale or (kind == "folded" and int(number) != folded):
                storage.delete(spark, f"{home}/{name}")
        closed = epochs[:-1]
        if not closed:
            return 0
        rows = self._read(spark, generation, folded, closed)
        sums = [F.sum(name).alias(name) for name in rows.columns if name not in self.keys]
        target = f"{home}/folded={closed[-1]}"
        _write(rows.groupBy(*self.keys).agg(*sums), target)
        storage.write_text(spark, f"{target}/{DONE_FILE}", "")
        return len(closed)
