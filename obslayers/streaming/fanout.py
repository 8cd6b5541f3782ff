"""One stream into several tables: rows, window averages and late rows from a single scan of the topic.

A micro-batch is written once, as clean rows. Everything else reads those back: the sums of the
windows they touch, the windows themselves, and the rows that came too late. Each table marks
its epoch as written, and a batch that is tried again goes on behind the last mark.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslayers import storage
from obslayers.operators.aggregates import windows_from_parts
from obslayers.schemas import EVENT_TIME
from obslayers.streaming.keyed import KeyedTable
from obslayers.streaming.parts import DailyParts
from obslayers.streaming.sinks import EPOCH_FILES, EpochTable


@dataclass(frozen=True)
class Watermarks:
    """The greatest event time of each epoch and all before it, in microseconds, beside the checkpoint.

    One small file an epoch, replaced when the epoch is repeated; the last ones are kept.
    """

    checkpoint: str
    keep: int = 100

    def _file(self, epoch: int) -> str:
        return f"{self.checkpoint}/_greatest_times/{epoch}"

    def before(self, spark: SparkSession, epoch: int) -> int | None:
        """The greatest event time of all epochs before this one."""
        names = storage.children(spark, f"{self.checkpoint}/_greatest_times")
        earlier = [int(name) for name in names if int(name) < epoch]
        text = storage.read_text(spark, self._file(max(earlier))) if earlier else ""
        return int(text) if text else None

    def note(self, spark: SparkSession, epoch: int, greatest: int | None) -> None:
        known = [time for time in (self.before(spark, epoch), greatest) if time is not None]
        if storage.exists(spark, self._file(epoch)):
            storage.delete(spark, self._file(epoch))
        storage.write_text(spark, self._file(epoch), str(max(known)) if known else "")
        for name in storage.children(spark, f"{self.checkpoint}/_greatest_times"):
            if int(name) <= epoch - self.keep:
                storage.delete(spark, self._file(int(name)))


def is_late(width: str, delay: str, greatest: int) -> F.Column:
    """Whether a row's window had ended ``delay`` before ``greatest`` (microseconds)."""
    closed = F.timestamp_micros(F.lit(greatest)) - F.expr(f"INTERVAL {delay}")
    return F.coalesce(F.window(F.col(EVENT_TIME), width).getField("end") <= closed, F.lit(False))


@dataclass(frozen=True)
class WindowFanOut:
    """Where a stream's batches go: ``rows``, ``windows`` by way of their ``parts``, and ``late`` rows.

    Without a ``delay`` no row is late. With one, a row whose window had ended that long before the
    greatest event time of the epochs before goes to ``late``, with its epoch, and not
    into its window; it is among ``rows`` like any other, and so is a row without a time, which is
    never late.
    """

    rows: EpochTable
    windows: KeyedTable
    parts: DailyParts
    checkpoint: str
    delay: str | None = None
    late: EpochTable | None = None
    files: int = EPOCH_FILES

    def __post_init__(self) -> None:
        if self.parts.window is None or (self.delay is None) != (self.late is None):
            raise ValueError("parts by window are needed, and a delay and a table of late rows go together")

    def generations(self, spark: SparkSession) -> dict[str, int]:
        """The generation to write each table with; to be opened before the stream starts."""
        found = {
            "rows": self.rows.open_generation(spark, self.checkpoint, "rows"),
            "parts": self.parts.open_generation(spark, self.checkpoint),
            "windows": self.windows.open_generation(spark, self.checkpoint),
        }
        if self.late is not None:
            found["late"] = self.late.open_generation(spark, self.checkpoint, "late")
        return found

    def write(self, batch: DataFrame, epoch: int, generations: dict[str, int]) -> None:
        """One micro-batch into all tables; what is marked as written is left as it is."""
        spark = batch.sparkSession
        if not self.rows.has(spark, generations["rows"], epoch):
            self.rows.write(batch, generations["rows"], epoch)
        written = self.rows.epoch(spark, generations["rows"], epoch)
        on_time = written
        if self.delay is not None:
            on_time = self._without_late(spark, written, epoch, generations["late"])
        if not self.windows.has(spark, generations["windows"], epoch):
            days = self.parts.add(on_time, generations["parts"], epoch)
            touched = on_time.select(F.window(F.col(EVENT_TIME), self.parts.window).getField("start").alias("window_start"))
            # Windows of those days that the batch has rows of; days prune, and the rest goes by a semi-join.
            parts = self.parts.read(spark, generations["parts"], days).join(touched.distinct(), "window_start", "left_semi")
            changed = windows_from_parts(parts).repartition(self.files, *self.windows.keys)
            self.windows.upsert(changed, generations["windows"], epoch)

    def _without_late(self, spark: SparkSession, rows: DataFrame, epoch: int, generation: int) -> DataFrame:
        marks = Watermarks(self.checkpoint)
        marks.note(spark, epoch, rows.agg(F.unix_micros(F.max(EVENT_TIME))).first()[0])
        greatest = marks.before(spark, epoch)
        late = F.lit(False) if greatest is None else is_late(self.parts.window, self.delay, greatest)
        if not self.late.has(spark, generation, epoch):
            self.late.write(rows.where(late), generation, epoch)
        return rows.where(~late)
