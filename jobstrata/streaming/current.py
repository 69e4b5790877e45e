"""Current state and history from a change feed, without a MERGE statement.

``CurrentState``: every micro-batch appends the newest change of each key it saw as ``delta/batch=``; reading
takes the newest change over base and deltas. Rerunning a batch overwrites its own folder, so
the result is exact after a failure. ``compact`` folds the deltas into a new base.

``ChangeHistory``: every micro-batch is committed once with all its changes; reading gives the states of each key over time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobstrata.operators.changes import change_history, current_rows
from jobstrata.operators.select import keep_latest
from jobstrata.sources.snapshots import FILE_BYTES, SnapshotTable
from jobstrata.streaming.sinks import LayerSink


class CurrentState:
    """``deleted`` is a SQL condition on changes that remove their key."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], ts: str, tiebreak: list[str], deleted: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys, self.ts, self.tiebreak, self.deleted = keys, ts, tiebreak, deleted

    def newest(self, df: DataFrame) -> DataFrame:
        return keep_latest(df, self.keys, self.ts, self.tiebreak)

    def apply(self, changes: DataFrame, batch: int) -> None:
        """Handler for ``foreachBatch``."""
        self.newest(changes).write.mode("overwrite").parquet(f"{self.root}/delta/batch={batch}")

    def _changes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/delta")

    def read(self) -> DataFrame:
        return current_rows(self._changes(), self.keys, self.ts, [*self.tiebreak, "batch"], self.deleted).drop("batch")

    def compact(self, target: str) -> "CurrentState":
        """Write the newest change of each key as the base of a new state folder and return that state.

        Deletes stay in it, as an older change of their key may still arrive.
        """
        base = CurrentState(self.spark, target, self.keys, self.ts, self.tiebreak, self.deleted)
        newest = keep_latest(self._changes(), self.keys, self.ts, [*self.tiebreak, "batch"]).drop("batch")
        newest.write.parquet(f"{base.root}/delta/batch=-1")
        return base


class ChangeHistory:
    def __init__(self, spark: SparkSession, root: str, schema, keys: list[str], sequence: str, tiebreak: list[str],
                 deleted: str | None = None, tracked: list[str] | None = None):
        self.table = SnapshotTable(spark, root, schema)
        self.keys, self.sequence, self.tiebreak, self.deleted, self.tracked = keys, sequence, tiebreak, deleted, tracked

    def sink(self, compact_every: int = 0, target: int = FILE_BYTES) -> LayerSink:
        """Its ``apply`` is the handler for ``foreachBatch``."""
        return LayerSink(self.table, "changes", sort=(*self.keys, self.sequence), compact_every=compact_every, target=target)

    def read(self) -> DataFrame:
        """All states of all keys, see ``change_history``."""
        return change_history(self.table.read(), self.keys, self.sequence, self.tiebreak, self.deleted, self.tracked)

    def current(self) -> DataFrame:
        return current_rows(self.table.read(), self.keys, self.sequence, self.tiebreak, self.deleted)
