"""Micro-batches into tables: bounded files, each batch once, expectations checked before anything shows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from jobstrata.operators.quality import Check, ExpectationFailed, Rules, passes
from jobstrata.session import adaptive
from jobstrata.sources.snapshots import FILE_BYTES, SnapshotTable

RESULTS = "layer string, batch bigint, rule string, action string, passed bigint, failed bigint"


def batch_key(batch: int, stem: str = "batch") -> str:
    return f"{stem}-{batch}"


class LayerSink:
    """``foreachBatch`` handler that appends every micro-batch to a table exactly once.

    * ``prepare`` turns the batch into rows of the table.
    * ``rules`` are counted while the rows are written; a row counts as failed where a rule is NULL.
    * ``checks`` with the action FAIL stop the batch: nothing of it is written, and the stream ends with
      ``ExpectationFailed``. Checks that compare rows (``unique``) need a pass of their own.
    * ``results`` receives the counts, one row per rule and batch, once.
    * ``stem`` names the stream: batches of another checkpoint that writes to the same table are told apart by it.
    * Every ``compact_every`` batches the small files of earlier ones are packed.

    A partition value with few rows ends in one file per batch, however many tasks had some of them; one with far more rows than
    the others is split over tasks by size.
    """

    def __init__(
        self, table: SnapshotTable, layer: str = "", prepare: Callable[[DataFrame], DataFrame] | None = None, rules: Rules | None = None,
        checks: list[Check] | None = None, results: SnapshotTable | None = None, sort: tuple[str, ...] = (), compact_every: int = 0,
        target: int = FILE_BYTES, stem: str = "batch",
    ):
        self.table, self.layer, self.prepare = table, layer, prepare
        self.rules, self.checks = rules or {}, checks or []
        self.results, self.sort = results, sort
        self.compact_every, self.target, self.stem = compact_every, target, stem
        self.totals: dict[str, int] = {}

    def apply(self, df: DataFrame, batch: int) -> None:
        with adaptive(df.sparkSession):
            self._apply(df, batch)

    def _apply(self, df: DataFrame, batch: int) -> None:
        key = batch_key(batch, self.stem)
        if self.table.committed(key):
            return
        if self.compact_every and batch and batch % self.compact_every == 0:
            self.table.compact(self.target, sort=self.sort)
        rows = self._rows(df, batch)
        each = [x for x in self.checks if not x.unique]
        seen = Observation()
        counts = [F.count_if(passes(rule)).alias(f"r{i}") for i, rule in enumerate(self.rules.values())]
        counts += [F.count_if(passes(x.rule)).alias(f"c{i}") for i, x in enumerate(each)]
        self.table.stage(rows.observe(seen, F.count(F.lit(1)).alias("total"), *counts), key, sort=self.sort)
        found = seen.get
        total = found.get("total", 0)
        outcome = [(name, "WARN", found.get(f"r{i}", 0)) for i, name in enumerate(self.rules)]
        outcome += [(x.name, x.action, found.get(f"c{i}", 0)) for i, x in enumerate(each)]
        outcome += self._unique(key, total)
        broken = [f"{name}: {total - good} rows" for name, action, good in outcome if action == "FAIL" and good < total]
        if broken:
            self.table.folder.delete(f"staging/{key}")
            raise ExpectationFailed(f"{self.layer} batch {batch}: " + ", ".join(broken))
        if self.results is not None and outcome:
            lines = [(self.layer, batch, name, action, good, total - good) for name, action, good in outcome]
            self.results.append(self.table.spark.createDataFrame(lines, RESULTS), batch_key(batch, self.layer), spread=False)
        self.table.commit(key)
        for name, count in [("total", total), *[(name, good) for name, _, good in outcome]]:
            self.totals[name] = self.totals.get(name, 0) + count

    def _rows(self, df: DataFrame, batch: int) -> DataFrame:
        return self.prepare(df) if self.prepare else df

    def _unique(self, key: str, total: int) -> list[tuple[str, str, int]]:
        """Rows that are the first of their value, for the staged rows of a batch."""
        columns = [x for x in self.checks if x.unique]
        if not columns:
            return []
        staged = self.table.spark.read.schema(self.table.schema).parquet(f"{self.table.root}/staging/{key}")
        more = [(F.count(x.rule) - F.count_distinct(F.col(x.rule))).alias(f"u{i}") for i, x in enumerate(columns)]
        row = staged.agg(*more).first()
        return [(x.name, x.action, total - row[f"u{i}"]) for i, x in enumerate(columns)]
