"""Ids seen so far, in hash buckets, for anti joins that read little of a long history.

Every load or micro-batch adds one small entry. ``compact`` merges entries of similar size and deals the ids into buckets of
about ``bucket_bytes``, more of them as the history grows. A lookup reads, of every merged entry, the buckets that its
own ids fall into. So what a micro-batch reads depends on its number of ids and, through the number of merged entries, on the
logarithm of the history, not on its age.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.operators.joins import narrow_history, not_in, usable
from jobstrata.sources.snapshots import Entry, SnapshotTable


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")


class IdStore:
    def __init__(self, spark: SparkSession, root: str, bucket_bytes: int = 32 << 20, compact_every: int = 16):
        self.table = SnapshotTable(spark, root, "id string, bucket int", ("bucket",))
        self.bucket_bytes = bucket_bytes
        self.compact_every = compact_every

    def add(self, ids: DataFrame, key: str, column: str = "job_id") -> bool:
        """Add ids under a key (such as a batch); NULL and empty ones are left out. A key counts once."""
        rows = ids.filter(usable(column)).select(F.col(column).cast("string").alias("id")).distinct()
        return self.table.append(rows.withColumn("bucket", F.lit(0)), key, sort=("id",), buckets=1)

    def _part(self, wanted: DataFrame, entries: list[Entry], n: int) -> DataFrame:
        """Rows of entries with n buckets that the wanted ids can meet."""
        keys = {x["key"] for x in entries}
        rows = self.table.read(only=lambda x: x["key"] in keys)
        if n == 1:
            return rows
        # At most n small numbers; where an id falls into most of the buckets, the filter would not help.
        needed = [x["b"] for x in wanted.select(_bucket(n).alias("b")).distinct().limit(n // 2 + 1).collect()]
        return rows.filter(F.col("bucket").isin(needed)) if len(needed) <= n // 2 else rows

    def history(self, df: DataFrame, column: str = "job_id") -> DataFrame:
        """The ids of the store, as ``column``, from the buckets that the ids of ``df`` fall into."""
        groups: dict[int, list[Entry]] = {}
        for entry in self.table.entries():
            if entry["files"]:
                groups.setdefault(entry["buckets"], []).append(entry)
        if not groups:
            return df.select(column).limit(0)
        wanted = df.filter(usable(column)).select(F.col(column).cast("string").alias("id"))
        parts = [self._part(wanted, entries, n) for n, entries in groups.items()]
        return reduce(DataFrame.unionByName, parts).select(F.col("id").cast(df.schema[column].dataType).alias(column))

    def unseen(self, df: DataFrame, column: str = "job_id") -> DataFrame:
        """Rows with a usable id that the store does not hold."""
        known = narrow_history(self.history(df, column), df, column)
        return not_in(df.filter(usable(column)), known, [column])

    def compact(self, least: int = 2) -> str | None:
        """Merge entries up to the first that is far larger than all smaller ones together; returns the new key.

        An id is rewritten once each time its entry doubles, and streams that use the store may run meanwhile.
        """
        found: list[Entry] = []
        size = 0
        for entry in sorted((x for x in self.table.entries() if x["files"]), key=lambda x: x["bytes"]):
            if len(found) >= least and entry["bytes"] > 2 * size:
                break
            found.append(entry)
            size += entry["bytes"]
        if len(found) < least:
            return None
        n = 1
        while n * self.bucket_bytes < size:
            n *= 2
        keys = {x["key"] for x in found}
        rows = self.table.read(only=lambda x: x["key"] in keys).select("id").distinct().withColumn("bucket", _bucket(n))
        return self.table.replace(found, rows.repartition(n, "bucket"), sort=("id",), buckets=n)

    def upkeep(self, number: int) -> None:
        """Compact every ``compact_every`` batches."""
        if number and number % self.compact_every == 0:
            self.compact()
