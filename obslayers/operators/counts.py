"""Row counts taken in the pass that reads or writes the rows, not by scans of their own.

Counts below a shuffle are for display: a stage that Spark repeats after a lost executor
counts its rows again.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

ROWS = "rows"


class PassCounts:
    """Counts of a batch job by name, there once the job's first action has ended."""

    def __init__(self) -> None:
        self._taken: dict[str, Observation] = {}

    def of(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, whose rows are counted under ``name`` when they pass."""
        self._taken[name] = Observation(name)
        return df.observe(self._taken[name], F.count(F.lit(1)).alias(ROWS))

    def rows(self) -> dict[str, int]:
        """All counts; waits for the first action on each of the frames."""
        return {name: taken.get[ROWS] for name, taken in self._taken.items()}


def counted(df: DataFrame, name: str) -> DataFrame:
    """A stream whose rows are counted under ``name`` in every micro-batch."""
    return df.observe(name, F.count(F.lit(1)).alias(ROWS))


class StreamCounts(StreamingQueryListener):
    """Sums of the counts that streams take, over all their micro-batches.

    ``spark.streams.addListener(counts)`` before the stream starts; restarts add on.
    """

    def __init__(self) -> None:
        self._sums: dict[str, dict[str, int]] = {}
        self._running: dict[str, str] = {}
        self._news = threading.Condition()

    def rows(self, query: StreamingQuery, seconds: float = 60) -> dict[str, int]:
        """The counts so far; of a stream that has ended all of them, for whose last report this waits."""
        with self._news:
            if not query.isActive and not self._news.wait_for(lambda: str(query.runId) not in self._running, seconds):
                raise TimeoutError(f"no end of {query.id} reported within {seconds} seconds")
            return dict(self._sums.get(str(query.id), {}))

    def onQueryStarted(self, event) -> None:
        with self._news:
            self._running[str(event.runId)] = str(event.id)

    def onQueryProgress(self, event) -> None:
        with self._news:
            sums = self._sums.setdefault(str(event.progress.id), {})
            for name, row in event.progress.observedMetrics.items():
                sums[name] = sums.get(name, 0) + row[ROWS]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._running.pop(str(event.runId), None)
            self._news.notify_all()
