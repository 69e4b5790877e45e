"""Column profiles that add up: counts and distinct-value sketches per batch and day, for any period without the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.operators.quality import _ratios
from jobstrata.session import adaptive
from jobstrata.sources.snapshots import SnapshotTable
from jobstrata.streaming.sinks import batch_key

PARTS = "day date, column string, total_rows bigint, value_count bigint, sketch binary"
# Size of a sketch as a power of two, and the relative standard error that goes with it.
SKETCH = 12
ERROR = 1.04 / 2 ** (SKETCH / 2)


class ColumnProfiles:
    """Rows, NULLs and estimated distinct values of columns per day.

    Sketches of days and batches merge into that of a period, as if all values had gone into one; a value that
    occurs on several days counts once. Each batch adds one row per day and column under its number.
    """

    def __init__(self, spark: SparkSession, root: str, columns: list[str], day: Column):
        self.table = SnapshotTable(spark, root, PARTS)
        self.columns, self.day = columns, day

    def parts(self, df: DataFrame) -> DataFrame:
        columns = range(len(self.columns))
        sketches = df.groupBy(self.day.alias("day")).agg(
            F.count("*").alias("total_rows"), *[F.count(c).alias(f"_c{i}") for i, c in enumerate(self.columns)],
            *[F.hll_sketch_agg(F.col(c).cast("string"), SKETCH).alias(f"_s{i}") for i, c in enumerate(self.columns)],
        )
        each = [F.struct(F.lit(self.columns[i]).alias("column"), F.col(f"_c{i}").alias("value_count"), F.col(f"_s{i}").alias("sketch")) for i in columns]
        return sketches.select("day", "total_rows", F.inline(F.array(*each))).select("day", "column", "total_rows", "value_count", "sketch")

    def apply(self, df: DataFrame, batch: int) -> None:
        """Handler for ``foreachBatch``."""
        with adaptive(df.sparkSession):
            self.table.append(self.parts(df).coalesce(1), batch_key(batch), spread=False)

    def _merged(self, rows: DataFrame, by: list[str]) -> DataFrame:
        sums = [F.sum(x).alias(x) for x in ("total_rows", "value_count")]
        return rows.groupBy(*by).agg(*sums, F.hll_union_agg("sketch").alias("sketch"))

    def read(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Profile of a period (of all days without bounds): column, total_rows, null_count, ratios, distinct_count."""
        rows = self.table.read()
        if first is not None:
            rows = rows.filter(F.col("day") >= first)
        if last is not None:
            rows = rows.filter(F.col("day") <= last)
        counts = self._merged(rows, ["column"])
        return _ratios(counts.select(
            "column", "total_rows", (F.col("total_rows") - F.col("value_count")).alias("null_count"), F.hll_sketch_estimate("sketch").alias("_distinct"),
        ))

    def compact(self) -> None:
        """One row per day and column in the place of all rows so far."""
        entries = self.table.entries()
        if sum(1 for x in entries if x["files"]) > 1:
            self.table.replace(entries, self._merged(self.table.read(), ["day", "column"]).coalesce(1), ("day", "column"))
