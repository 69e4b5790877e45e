"""Streaming dedup by a stable key: within a watermark, or exactly against all ids seen so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata import vocab
from jobstrata.operators.joins import usable
from jobstrata.operators.select import keep_first
from jobstrata.sources.idstore import IdStore
from jobstrata.sources.snapshots import SnapshotTable
from jobstrata.streaming.sinks import LayerSink, batch_key


def with_event_watermark(df: DataFrame, ts: str, delay: str = vocab.WATERMARK) -> DataFrame:
    """Watermark on event time, so late rows are judged by when they were extracted."""
    return df.withWatermark(ts, delay)


def drop_repeats(df: DataFrame, key: list[str], ts: str, delay: str = vocab.WATERMARK, salts: int = 8) -> DataFrame:
    """First row of each key; repeats within the watermark delay are dropped, and so are rows behind the watermark.

    A first step drops repeats per key and input task (modulo ``salts``), which spreads a
    hot key over ``salts`` tasks and leaves at most that many of its rows for the second step. ``salts=1`` skips it.
    """
    marked = with_event_watermark(df, ts, delay)
    if salts > 1:
        marked = (
            marked.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
            .dropDuplicatesWithinWatermark([*key, "_salt"])
            .drop("_salt")
        )
    return marked.dropDuplicatesWithinWatermark(key)


class UniqueSink(LayerSink):
    """A layer in which every id occurs once, whenever its rows arrive.

    Within a batch the row with the least ``ts`` stays, and rows of ids in ``ids`` go. Nothing is dropped for being late: a
    first row behind the watermark that ``delay`` would have set is kept and counted. Rows without an id cannot be told to be
    repeats; they stay. ``repeats`` gets one row of counts per batch.
    """

    COUNTS = "batch bigint, rows bigint, kept bigint, no_id bigint, repeated bigint, late_kept bigint, newest timestamp"

    def __init__(self, table: SnapshotTable, layer: str = "", *, ids: IdStore, key: str, ts: str, repeats: SnapshotTable | None = None,
                 delay: str = vocab.WATERMARK, stem: str = "batch", **options):
        super().__init__(table, layer, stem=stem, **options)
        self.ids, self.key, self.ts, self.repeats, self.delay = ids, key, ts, repeats, delay

    @staticmethod
    def repeats_table(spark: SparkSession, root: str) -> SnapshotTable:
        return SnapshotTable(spark, root, UniqueSink.COUNTS)

    def _rows(self, df: DataFrame, batch: int) -> DataFrame:
        self.ids.upkeep(batch)
        has_id = F.coalesce(usable(self.key), F.lit(False))
        # A tie in time goes by the whole row, so that a rerun keeps the same one.
        columns = [F.col(c) if not t.startswith("map") else F.map_entries(c) for c, t in df.dtypes]
        marked = df.withColumn("_content", F.xxhash64(*[F.to_json(F.struct(*columns))]))
        first = keep_first(marked.filter(has_id), [self.key], [self.ts, "_content"]).drop("_content")
        return self.ids.unseen(first, self.key).unionByName(df.filter(~has_id))

    def _apply(self, df: DataFrame, batch: int) -> None:
        key = batch_key(batch, self.stem)
        rows = super()._rows(df, batch).persist()
        try:
            super()._apply(rows, batch)
            # The ids follow from what was committed, so a rerun after a stop in between adds the same ones.
            if not self.ids.table.committed(key):
                kept = self.table.read(only=lambda x: x["key"] == key)
                self.ids.add(kept, key, self.key)
            if self.repeats is not None and not self.repeats.committed(key):
                self.repeats.append(self._counts(rows, key, batch), key, spread=False)
        finally:
            rows.unpersist()

    def _counts(self, rows: DataFrame, key: str, batch: int) -> DataFrame:
        has_id = F.coalesce(usable(self.key), F.lit(False))
        newest = self.repeats.read().agg(F.max("newest")).first()[0]
        late = F.col(self.ts) < F.lit(newest) - F.expr(f"INTERVAL {self.delay}") if newest else F.lit(False)
        came = rows.agg(
            F.count("*").alias("rows"), F.count_if(~has_id).alias("no_id"), F.greatest(F.max(self.ts), F.lit(newest).cast("timestamp")).alias("newest")
        )
        kept = self.table.read(only=lambda x: x["key"] == key).agg(F.count("*").alias("kept"), F.count_if(has_id & late).alias("late_kept"))
        return came.crossJoin(kept).select(
            F.lit(batch).cast("bigint").alias("batch"), "rows", "kept", "no_id", (F.col("rows") - F.col("kept")).alias("repeated"), "late_kept", "newest"
        )
