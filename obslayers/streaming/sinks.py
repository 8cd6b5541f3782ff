"""Stream writers: parquet, console, keyed tables and whole-result snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from obslayers import storage
from obslayers.sources.tables import STREAM_SINK_LOG
from obslayers.streaming.generations import open_generation

# Files, and writing tasks, of a micro-batch's upsert unless a sink is told otherwise.
EPOCH_FILES = 32


def claim(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse a stream with a new checkpoint into a table that another checkpoint has written.

    The parquet sink's log would take the new stream's first batches for written.
    """
    new = not storage.exists(spark, f"{checkpoint}/metadata")
    if new and storage.exists(spark, f"{path}/{STREAM_SINK_LOG}"):
        raise ValueError(f"{path} was written with another checkpoint than {checkpoint}; give another folder")


def to_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataStreamWriter:
    """Append rows to a parquet table, each exactly once."""
    writer = df.writeStream.format("parquet").option("path", path)
    return writer.partitionBy(*partition_by) if partition_by else writer


def to_console(df: DataFrame, truncate: bool = False, rows: int = 20) -> DataStreamWriter:
    """Print each micro-batch."""
    return df.writeStream.format("console").option("truncate", truncate).option("numRows", rows)


def to_keyed(
    df: DataFrame,
    target,
    generation: int = 0,
    files: int = EPOCH_FILES,
    compact_every: int | None = None,
) -> DataStreamWriter:
    """Upsert each micro-batch into a keyed ``target``.

    Update mode sends the groups that changed. They are gathered into ``files`` files
    instead of one per state partition; groups are unique in a batch, so that shuffle
    is even and carries aggregates only. With ``compact_every`` a keyed parquet table
    is compacted after every so many micro-batches, which bounds the files a reader
    has to open.
    """
    # The stream's own session has adaptive execution off.
    session = df.sparkSession

    def upsert(batch: DataFrame, epoch: int) -> None:
        target.upsert(batch.repartition(files, *target.keys), generation, epoch)
        if compact_every and (epoch + 1) % compact_every == 0:
            target.compact(session)

    return df.writeStream.foreachBatch(upsert)


@dataclass(frozen=True)
class Snapshots:
    """The whole result of each trigger, for streams in complete mode.

    A trigger writes its own folder, so repeating it changes nothing and readers of
    an earlier one are not disturbed; all but the last two are dropped.
    """

    path: str

    def _epochs(self, spark: SparkSession) -> list[int]:
        names = storage.children(spark, self.path)
        return sorted(
            int(name.removeprefix("epoch="))
            for name in names
            if name.startswith("epoch=") and storage.exists(spark, f"{self.path}/{name}/_SUCCESS")
        )

    def write(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")
        for old in self._epochs(spark):
            if old < epoch - 1:
                storage.delete(spark, f"{self.path}/epoch={old}")

    def last(self, spark: SparkSession) -> DataFrame:
        epochs = self._epochs(spark)
        if not epochs:
            raise ValueError(f"no result in {self.path} yet")
        return spark.read.parquet(f"{self.path}/epoch={epochs[-1]}")


@dataclass(frozen=True)
class EpochTable:
    """Rows filed by the micro-batch that wrote them; an epoch counts once Spark has marked its folder.

    A new checkpoint begins a new generation, and readers see the newest one.
    """

    path: str

    def open_generation(self, spark: SparkSession, checkpoint: str, note: str) -> int:
        return open_generation(spark, self.path, checkpoint, note)

    def _folder(self, generation: int, epoch: int) -> str:
        return f"{self.path}/generation={generation}/epoch={epoch}"

    def has(self, spark: SparkSession, generation: int, epoch: int) -> bool:
        return storage.exists(spark, f"{self._folder(generation, epoch)}/_SUCCESS")

    def write(self, rows: DataFrame, generation: int, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(self._folder(generation, epoch))

    def epoch(self, spark: SparkSession, generation: int, epoch: int) -> DataFrame:
        return spark.read.parquet(self._folder(generation, epoch))

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows of the newest generation, with its ``epoch``."""
        generations = [name for name in storage.children(spark, self.path) if name.startswith("generation=")]
        newest = max((int(name.split("=")[1]) for name in generations), default=0)
        home = f"{self.path}/generation={newest}"
        epochs = [name for name in storage.children(spark, home) if storage.exists(spark, f"{home}/{name}/_SUCCESS")]
        if not epochs:
            raise ValueError(f"nothing written to {self.path} yet")
        return spark.read.option("basePath", home).parquet(*[f"{home}/{name}" for name in epochs])


def to_snapshots(df: DataFrame, snapshots: Snapshots) -> DataStreamWriter:
    """Write the whole result of each trigger; for complete mode."""
    return df.writeStream.foreachBatch(snapshots.write)
