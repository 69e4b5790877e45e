"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.session import materialize

__all__ = ["SPACES", "aside", "crc_rest", "documents", "materialize", "release", "slices", "table", "text_or_empty", "hex16", "with_row_id"]

# The white space of the contracts: blank and the five controls from tab to carriage return.
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_or_empty(column: str | Column = "text") -> Column:
    """The text, a null as the empty one."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def crc_rest(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo; decides which rows are held out. Null for a null value."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def hex16(column: str | Column) -> Column:
    """A long as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """A key of its own for every row of a scan, repeated rows included.

    The number follows from the input split and the place in it, so a task that runs again gives the same.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def aside(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """The frame with columns of these names renamed to unused ones, and the renaming back."""
    back: dict[str, str] = {}
    for name in names:
        if name in df.columns:
            other = name + "_"
            while other in df.columns or other in back:
                other += "_"
            back[other] = name
    return df.withColumnsRenamed({name: other for other, name in back.items()}), back


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose result has been written.

    Its cleaner acts when the driver's garbage collector drops the last reference, which on a quiet driver may be long after.
    """
    spark.sparkContext._jvm.System.gc()


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the strings of a column take about ``limit`` bytes; a longer row stays alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())
        ends = pc.cumulative_sum(sizes).to_numpy()
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(ends.searchsorted(base + limit, side="right")))
            yield batch.slice(start, stop - start)
            base, start = int(ends[stop - 1]), stop
