"""Keyed tables: the newest row per key.

``KeyedTable`` keeps them as parquet; ``CassandraTable`` hands rows to the
Cassandra connector, where a write replaces the row of the same primary key.

A ``KeyedTable`` folder holds

* ``log/generation=G/epoch=E`` -- the rows one micro-batch or batch run wrote. The
  folder is replaced when the epoch is repeated, so a repeat changes nothing.
* ``base/run=R/day=D`` -- rows folded out of the log by compaction, by day.
* ``_generations/G`` -- one empty file per generation handed out.

The newest row is the one with the highest generation and, within it, the highest
epoch; one writer at a time holds the newest generation. Compaction only adds files:
a finished run names the epochs it folded, readers then take those from the base,
and the files it replaces are removed a compaction later.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslayers import storage
from obslayers.functions.times import calendar_day
from obslayers.streaming.generations import open_generation

POSITION = "position"
# Epochs stay below 2**40 in one generation.
EPOCH_BITS = 40
FOLDED_FILE = "_folded"
KEEP_SECONDS = 3600.0


@dataclass(frozen=True)
class CassandraTable:
    """A table of an existing Cassandra cluster; needs the connector on the class path."""

    keyspace: str
    table: str
    keys: tuple[str, ...] = ()

    def open_generation(self, spark: SparkSession, checkpoint: str | None = None) -> int:
        return 0

    def upsert(self, df: DataFrame, generation: int = 0, epoch: int = 0) -> None:
        (
            df.write.format("org.apache.spark.sql.cassandra")
            .mode("append")
            .option("keyspace", self.keyspace)
            .option("table", self.table)
            .save()
        )

    def latest(self, spark: SparkSession) -> DataFrame:
        return (
            spark.read.format("org.apache.spark.sql.cassandra")
            .option("keyspace", self.keyspace)
            .option("table", self.table)
            .load()
        )


@dataclass(frozen=True)
class KeyedTable:
    """Newest row per ``keys`` under ``path``; ``time_key`` is the key that dates a row.

    What a compaction has replaced stays for ``keep_seconds``, for readers that began before it.
    """

    path: str
    keys: tuple[str, ...]
    time_key: str
    keep_seconds: float = KEEP_SECONDS

    # -- writing -----------------------------------------------------------------

    def open_generation(self, spark: SparkSession, checkpoint: str | None = None) -> int:
        """The generation to write with: the checkpoint's own, else a new one that wins over all earlier."""
        return open_generation(spark, self.path, checkpoint)

    def upsert(self, df: DataFrame, generation: int, epoch: int = 0) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/log/generation={generation}/epoch={epoch}")

    def has(self, spark: SparkSession, generation: int, epoch: int) -> bool:
        """Whether this epoch is written whole."""
        return storage.exists(spark, f"{self.path}/log/generation={generation}/epoch={epoch}/_SUCCESS")

    # -- reading -----------------------------------------------------------------

    def _finished_runs(self, spark: SparkSession) -> list[int]:
        """Compaction runs that completed, newest first."""
        root = f"{self.path}/base"
        runs = [int(name.split("=")[1]) for name in storage.children(spark, root)]
        return sorted((run for run in runs if storage.exists(spark, f"{root}/run={run}/{FOLDED_FILE}")), reverse=True)

    def _folded_by(self, spark: SparkSession, run: int) -> list[str]:
        return storage.read_text(spark, f"{self.path}/base/run={run}/{FOLDED_FILE}").split()

    def _days_of(self, spark: SparkSession, run: int) -> list[str]:
        return [name for name in storage.children(spark, f"{self.path}/base/run={run}") if name.startswith("day=")]

    def _epochs(self, spark: SparkSession, runs: Sequence[int]) -> list[str]:
        """Finished log folders that are not folded yet, oldest first.

        Spark moves a job's files one by one and then marks the folder; one without the
        mark is still being written, or is left from an attempt that a retry repeats.
        """
        folded = {epoch for run in runs for epoch in self._folded_by(spark, run)}
        found = []
        for generation in storage.children(spark, f"{self.path}/log"):
            for epoch in storage.children(spark, f"{self.path}/log/{generation}"):
                if f"{generation}/{epoch}" in folded:
                    continue
                if storage.exists(spark, f"{self.path}/log/{generation}/{epoch}/_SUCCESS"):
                    found.append((int(generation.split("=")[1]), int(epoch.split("=")[1])))
        return [f"generation={generation}/epoch={epoch}" for generation, epoch in sorted(found)]

    def _log_rows(self, spark: SparkSession, epochs: Sequence[str]) -> DataFrame:
        root = f"{self.path}/log"
        rows = spark.read.option("basePath", root).parquet(*[f"{root}/{epoch}" for epoch in epochs])
        position = F.shiftleft(F.col("generation").cast("long"), EPOCH_BITS) + F.col("epoch")
        return rows.withColumn(POSITION, position).drop("generation", "epoch")

    def _base_rows(
        self, spark: SparkSession, runs: Sequence[int], wanted: Callable[[str], bool] = lambda day: True
    ) -> DataFrame | None:
        """Folded rows, one per key: each day as the newest run that touched it left it.

        Only the folders of ``wanted`` days are read.
        """
        root, newest = f"{self.path}/base", {}
        for run in runs:
            for day in self._days_of(spark, run):
                if wanted(day):
                    newest.setdefault(day, f"{root}/run={run}/{day}")
        if not newest:
            return None
        return spark.read.option("basePath", root).parquet(*newest.values()).drop("run")

    def _newest(self, rows: DataFrame) -> DataFrame:
        # One max_by per column over a long position keeps this a hash aggregate;
        # a struct in the aggregation buffer would make it sort.
        others = [name for name in rows.columns if name not in (*self.keys, POSITION)]
        return rows.groupBy(*self.keys).agg(
            *[F.max_by(F.col(name), F.col(POSITION)).alias(name) for name in others],
            F.max(POSITION).alias(POSITION),
        )

    def _day(self) -> Column:
        return calendar_day(F.col(self.time_key))

    def latest(self, spark: SparkSession, since: str | None = None, until: str | None = None) -> DataFrame:
        """The newest row per key; ``since`` and ``until`` (inclusive days) prune the files read.

        Only the log is aggregated. The base holds one row per key already and gives
        those that the log does not replace, without a shuffle while the log is small.
        """
        runs = self._finished_runs(spark)

        def within(day: str) -> bool:
            return (since is None or day >= f"day={since}") and (until is None or day <= f"day={until}")

        epochs, base = self._epochs(spark, runs), self._base_rows(spark, runs, within)
        if not epochs and base is None:
            # With bounds, days outside them may be all there is: then the result is theirs without a row.
            base = self._base_rows(spark, runs)
            if base is None:
                raise ValueError(f"nothing written to {self.path} yet")
            base = base.limit(0)
        if base is not None:
            base = base.drop("day", POSITION)
            if not epochs:
                return base
        log = self._log_rows(spark, epochs)
        if since is not None:
            log = log.filter(F.col(self.time_key) >= F.lit(since).cast("date"))
        if until is not None:
            log = log.filter(F.col(self.time_key) < F.date_add(F.lit(until).cast("date"), 1))
        newest = self._newest(log).drop(POSITION)
        if base is None:
            return newest
        replaced = newest.select(*self.keys)
        return newest.unionByName(base.join(replaced, list(self.keys), "left_anti"))

    # -- compaction --------------------------------------------------------------

    def drop_replaced(self, spark: SparkSession, keep_seconds: float = 0) -> None:
        """Remove files that compactions finished ``keep_seconds`` ago or earlier have replaced."""
        root, runs = f"{self.path}/base", self._finished_runs(spark)
        old = [r for r in runs if storage.age(spark, f"{root}/run={r}/{FOLDED_FILE}") >= keep_seconds]
        for name in storage.children(spark, root):
            # A run that broke off: the log and the older base still hold all its rows.
            if int(name.split("=")[1]) not in runs:
                storage.delete(spark, f"{root}/{name}")
        newer: set[str] = set()
        for run in old:
            for epoch in self._folded_by(spark, run):
                storage.delete(spark, f"{self.path}/log/{epoch}")
            days = set(self._days_of(spark, run))
            for day in days & newer:
                storage.delete(spark, f"{root}/run={run}/{day}")
            if run != old[0] and days <= newer:
                storage.delete(spark, f"{root}/run={run}")
            newer |= days

    def compact(self, spark: SparkSession) -> int:
        """Fold closed epochs into the base; returns how many were folded.

        Only days that the folded epochs touch are rewritten. Safe beside a running
        stream, since its newest epoch, the only one a retry can write again, is left
        alone; two compactions must not overlap.
        """
        self.drop_replaced(spark, self.keep_seconds)
        runs = self._finished_runs(spark)
        epochs = self._epochs(spark, runs)[:-1]
        if not epochs:
            return 0
        rows = self._log_rows(spark, epochs)
        # At most one value per calendar day, so that the base is pruned by folder.
        touched = {f"day={row.day}" for row in rows.select(self._day().alias("day")).distinct().collect()}
        base = self._base_rows(spark, runs, touched.__contains__)
        if base is not None:
            rows = rows.unionByName(base.drop("day"))
        merged = self._newest(rows).withColumn("day", self._day())
        target = f"{self.path}/base/run={max(runs, default=0) + 1}"
        # A rebalance by day gives few files per day and splits a day that is too large.
        merged.hint("rebalance", "day").write.partitionBy("day").parquet(target)
        storage.write_text(spark, f"{target}/{FOLDED_FILE}", "\n".join(epochs))
        return len(epochs)


@dataclass(frozen=True)
class Serving:
    """Keyed tables as temporary views.

    A view is of its table at the last ``refresh``: rows written since then are not in it, and its files
    may be gone ``keep_seconds`` after a compaction. ``sql`` refreshes first; a result that
    is kept for longer than that must be asked for again.
    """

    spark: SparkSession
    views: dict[str, KeyedTable | CassandraTable]

    def refresh(self) -> None:
        for name, table in self.views.items():
            table.latest(self.spark).createOrReplaceTempView(name)

    def sql(self, query: str) -> DataFrame:
        """``query`` over the newest rows there are now."""
        self.refresh()
        return self.spark.sql(query)


def serve(spark: SparkSession, views: dict[str, KeyedTable | CassandraTable]) -> Serving:
    """Register the newest rows of each table, as of now, as a temporary view of that name."""
    serving = Serving(spark, views)
    serving.refresh()
    return serving
