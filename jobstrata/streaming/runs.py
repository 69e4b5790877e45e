"""Run streams to completion or on a timer."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery


def append_parquet(
    df: DataFrame, path: str, checkpoint: str, partitions: tuple[str, ...] = (), every: str | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet table; without ``every`` it stops when the input is used up."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.outputMode("append").trigger(**trigger).start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for a triggered query and pass on its failure."""
    query.awaitTermination()


class ObservedTotals(StreamingQueryListener):
    """Counts of all observations of each run, added up as its micro-batches end, however many there are."""

    def __init__(self) -> None:
        self._totals: dict[str, dict[str, dict[str, int]]] = {}
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        totals = self._totals.setdefault(str(event.progress.runId), {})
        for name, row in event.progress.observedMetrics.items():
            into = totals.setdefault(name, {})
            for metric, value in row.asDict().items():
                into[metric] = into.get(metric, 0) + value

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def of(self, query: StreamingQuery, wait: float = 120) -> dict[str, dict[str, int]]:
        """Totals of a run that has ended. Events arrive in order, so its end is behind its last batch."""
        run = str(query.runId)
        if not self._ended.setdefault(run, threading.Event()).wait(wait):
            raise TimeoutError(f"no end of run {run} was reported within {wait} s")
        return self._totals.get(run, {})


@contextmanager
def observed_totals(spark: SparkSession) -> Iterator[ObservedTotals]:
    """Listen to the runs that start inside the block."""
    listener = ObservedTotals()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def each_batch(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()
