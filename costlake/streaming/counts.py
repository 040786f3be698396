"""Rows that stateful streams leave out, counted over whole runs."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Condition

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class DroppedRows(StreamingQueryListener):
    """Adds up each progress report as it comes. A query itself keeps only its last reports
    (``spark.sql.streaming.numRecentProgressUpdates``), so a long drain can't be counted from those."""

    def __init__(self) -> None:
        self._late: Counter[str] = Counter()
        self._copies: Counter[str] = Counter()
        self._ended: set[str] = set()
        self._changed = Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        for operator in event.progress.stateOperators:
            self._late[run] += operator.numRowsDroppedByWatermark
            self._copies[run] += int(operator.customMetrics.get("numDroppedDuplicateRows", 0))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def of(
        self, queries: list[StreamingQuery], patience: float = 300.0
    ) -> tuple[int, int] | tuple[None, None]:
        """(late rows, copies) of ended queries. Reports follow a query with a delay, so this waits
        for the last one. Without it the counts are unknown (None), which is no reason to fail: the rows
        are written."""
        runs = {str(query.runId) for query in queries}
        with self._changed:
            if not self._changed.wait_for(lambda: runs <= self._ended, patience):
                return None, None
        return sum(self._late[run] for run in runs), sum(self._copies[run] for run in runs)


@contextmanager
def dropped_rows(spark: SparkSession) -> Iterator[DroppedRows]:
    """Counts for the streams started inside the block."""
    listener = DroppedRows()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
