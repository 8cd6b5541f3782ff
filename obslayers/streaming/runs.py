"""Starting a stream and waiting for it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from obslayers import storage
from obslayers.session import settings

UNTIL_CAUGHT_UP = "available now"


def state_partitions(spark: SparkSession) -> int:
    """State partitions of a stream that is not told otherwise: the session's shuffle partitions.

    A stream keeps the number of its first start for good, so it is a setting and not
    the number of cores that happen to be there.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def start(
    spark: SparkSession,
    writer: DataStreamWriter,
    mode: str = "append",
    every: str | None = None,
    checkpoint: str | None = None,
    partitions: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start ``writer`` in an output mode: ``append``, ``update`` or ``complete``.

    ``every`` is the interval between micro-batches, ``UNTIL_CAUGHT_UP`` to process
    what is there and end, or None to go on as fast as batches finish. State is
    spread over ``partitions`` shuffle partitions; the first start with a
    checkpoint fixes that number for good.
    """
    writer = writer.outputMode(mode)
    if every == UNTIL_CAUGHT_UP:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    conf = {"spark.sql.shuffle.partitions": str(partitions or state_partitions(spark))}
    with settings(spark, conf):
        return writer.start()


def wait(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Wait for one stream to end; True when it did, False when the time ran out first."""
    if seconds is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(seconds))


def wait_any(spark: SparkSession, seconds: float | None = None) -> bool:
    """Wait until any stream of the session ends."""
    if seconds is None:
        spark.streams.awaitAnyTermination()
        return True
    return bool(spark.streams.awaitAnyTermination(seconds))


def wait_all(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Wait until all ``queries`` have ended; when one fails, stop the others and raise its error.

    Streams of the session that are not among ``queries`` may end or fail meanwhile. Other
    waiters for any stream of the session miss those that end in between.
    """
    queries = list(queries)
    while True:
        # Whatever ends after this wakes the wait below, so nothing is missed in between.
        spark.streams.resetTerminated()
        failed = next((q for q in queries if not q.isActive and q.exception() is not None), None)
        if failed is not None:
            for query in queries:
                if query.isActive:
                    query.stop()
            raise failed.exception()
        if not any(query.isActive for query in queries):
            return
        try:
            spark.streams.awaitAnyTermination()
        except StreamingQueryException:
            continue


def drop_checkpoint(spark: SparkSession, checkpoint: str) -> None:
    """Forget a stuck stream's progress and state; its next start begins a new generation.

    A keyed table takes the new generation beside the old one. A parquet table that a stream has written does
    not: its sink counts batches from the old checkpoint and would pass over the new
    ones, so a start with a new checkpoint is refused there (``sinks.claim``). Appended
    rows are not taken back by a reset; the stream goes on into another folder, and a
    topic read from its start is there again in full.
    """
    storage.delete(spark, checkpoint)


class LateRows(StreamingQueryListener):
    """Counts the rows of each stream that were dropped because their window had closed.

    A query's own progress reports go back a hundred batches only, so this listens to
    all of them: ``spark.streams.addListener(late)`` before the stream starts.
    """

    def __init__(self) -> None:
        self._dropped: dict[str, int] = {}

    def of(self, query: StreamingQuery) -> int:
        """Rows dropped so far, over all restarts that were listened to."""
        return self._dropped.get(str(query.id), 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        name = str(event.progress.id)
        dropped = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        self._dropped[name] = self._dropped.get(name, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
