"""Daily metrics kept up to date: partial sums per micro-batch that add up to what one pass over everything gives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.session import adaptive
from jobstrata.sources.snapshots import SnapshotTable
from jobstrata.streaming.sinks import batch_key

PARTS = "event_date date, volume bigint, latency_n bigint, latency_sum bigint, total bigint, kept bigint"
_SUMS = ("volume", "latency_n", "latency_sum", "total", "kept")


class DailyMetrics:
    """Volume, mean latency in seconds and rejection rate per day, from whole numbers that add up exactly.

    A micro-batch adds one short row per day it touches, under its number, so that it counts once. Reading adds up these rows;
    ``compact`` does so for good. No day is counted again from its data.
    """

    def __init__(self, spark: SparkSession, root: str, day: Column, latency: Column | None = None, kept: Column | None = None):
        self.table = SnapshotTable(spark, root, PARTS)
        self.day = day
        self.latency = F.lit(None).cast("bigint") if latency is None else latency.cast("bigint")
        self.kept = F.lit(True) if kept is None else F.coalesce(kept, F.lit(False))

    def parts(self, df: DataFrame) -> DataFrame:
        return df.groupBy(self.day.alias("event_date")).agg(
            F.count("*").alias("volume"), F.count(self.latency).alias("latency_n"), F.coalesce(F.sum(self.latency), F.lit(0)).alias("latency_sum"),
            F.count("*").alias("total"), F.count_if(self.kept).alias("kept"),
        )

    def apply(self, df: DataFrame, batch: int) -> None:
        """Handler for ``foreachBatch``."""
        with adaptive(df.sparkSession):
            self.table.append(self.parts(df).coalesce(1), batch_key(batch), spread=False)

    def _added(self) -> DataFrame:
        return self.table.read().groupBy("event_date").agg(*[F.sum(x).alias(x) for x in _SUMS])

    def read(self) -> DataFrame:
        """event_date, volume, mean_latency_s, total, kept, rejection_rate."""
        rejected = (F.col("total") - F.col("kept")) / F.col("total")
        mean = F.try_divide(F.col("latency_sum"), F.col("latency_n"))
        return self._added().select("event_date", "volume", mean.alias("mean_latency_s"), "total", "kept", rejected.alias("rejection_rate"))

    def compact(self) -> None:
        """One row per day in the place of all rows so far."""
        entries = self.table.entries()
        if sum(1 for x in entries if x["files"]) > 1:
            self.table.replace(entries, self._added().coalesce(1), ("event_date",))
