"""Session builder and scoped settings."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job relies on or gains from. Calendar days and hour buckets are
# taken in the session zone, so the zone is pinned. Adaptive execution sizes
# shuffle partitions from the data. RocksDB keeps window state off the heap and
# checkpoints changes instead of whole snapshots. A few open files per task let
# tables partitioned by day be written without sorting the rows by day first.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Strict jobs rely on failing casts and times.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Additional settings for a large cluster: fewer, larger scan tasks keep the map
# side of the aggregations effective and the task count manageable, and output
# partitions follow a size target rather than the core count. The state stores of one
# executor share a bounded amount of memory.
CLUSTER = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "2000",
}


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    cluster: bool = False,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with the package defaults.

    ``master`` is left to ``spark-submit`` unless given. ``conf`` wins over the
    defaults.
    """
    settings = dict(DEFAULTS)
    if cluster:
        settings.update(CLUSTER)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Set ``conf`` for the block and put the previous values back after it.

    A streaming query copies the session when it starts, so settings made around
    ``start()`` stay with that query.
    """
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
