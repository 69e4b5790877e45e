"""Posting files: batch and streaming readers, rescued fields, table writers."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata import schemas, vocab
from jobstrata.functions.dates import path_extract_date


def ingest_json_stream(
    spark: SparkSession, root: str, schema: T.StructType, max_files: int = vocab.MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """Stream of JSON files below ``root``, files already there included."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .json(root)
    )


def ingest_text_stream(
    spark: SparkSession, root: str, names: str = "*", max_files: int = vocab.MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """Stream of raw JSON lines, for ``with_rescued``; ``names`` is a glob on file names."""
    return (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", names)
        .option("maxFilesPerTrigger", max_files)
        .text(root)
    )


def read_text_lines(spark: SparkSession, root: str, names: str = "*") -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names).text(root)


def domain_glob(domain: str) -> str:
    """Glob for files that start with the domain in any case.

    It is applied while files are listed, so files of other domains are never opened.
    """
    return "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in domain) + "_*"


def is_domain_file(name: Column, domain: str) -> Column:
    """File name starts with the domain and ends in .json or .jsonl, in any case."""
    return name.rlike(rf"(?i)^{domain}_.*\.json(l)?$")


def filter_source_files(df: DataFrame, domain: str) -> DataFrame:
    return df.filter(is_domain_file(F.col("_metadata.file_name"), domain))


def with_lineage(df: DataFrame) -> DataFrame:
    """Ingestion time, source file and extraction date, read off the file metadata."""
    return df.select(
        "*",
        F.current_timestamp().alias("ingestion_timestamp"),
        F.col("_metadata.file_path").alias("source_file"),
        path_extract_date(F.col("_metadata.file_path"), F.col("_metadata.file_name")).alias("extract_date"),
    )


def with_rescued(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse JSON text into the schema's columns and keep what does not fit.

    ``_rescued_data`` maps field names to their raw text: fields outside the schema, fields
    whose value has the wrong type, or the whole line under ``_corrupt_record`` when it is no
    JSON object. It is NULL for rows that fit.
    """
    raw = F.from_json(F.col(value), "map<string,string>")
    parsed = df.withColumn("_typed", F.from_json(F.col(value), schema)).withColumn("_raw", raw)
    typed = [f.name for f in schema.fields if f.dataType != T.StringType()]
    misfit = F.array_compact(
        F.array(
            *[F.when(F.col(f"_typed.{c}").isNull() & F.col("_raw")[c].isNotNull(), F.lit(c)) for c in typed]
        )
    ).cast("array<string>")
    extra = F.map_filter(
        F.col("_raw"), lambda k, v: ~k.isin(schema.fieldNames()) | F.array_contains(misfit, k)
    )
    rescued = (
        F.when(F.col("_raw").isNull(), F.create_map(F.lit("_corrupt_record"), F.col(value)))
        .when(F.size(extra) > 0, extra)
    )
    others = [c for c in df.columns if c != value]
    return parsed.select(
        *others, *[F.col(f"_typed.{c}").alias(c) for c in schema.fieldNames()], rescued.alias("_rescued_data")
    )


def read_raw_json(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """JSON with an inferred schema: one object per line, or arrays over several lines."""
    return spark.read.option("multiLine", multiline).json(path)


def register_raw(
    spark: SparkSession, name: str, path: str, multiline: bool = False,
    comment: str = "", properties: dict[str, str] | None = None,
) -> DataFrame:
    """Make raw JSON files queryable under a table name."""
    quote = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    props = ", ".join(f"{quote(k)} = {quote(v)}" for k, v in (properties or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} USING JSON "
        f"OPTIONS (path {quote(path)}, multiLine '{str(multiline).lower()}') "
        f"COMMENT {quote(comment)}" + (f" TBLPROPERTIES ({props})" if props else "")
    )
    kept = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}.get("Location", "")
    same = lambda text: unquote(re.sub(r"^[a-z0-9]+:/*", "/", text)).rstrip("/")
    if same(kept) != same(path):
        raise ValueError(f"table {name} exists already, over {kept}")
    return spark.table(name)


def file_counts(df: DataFrame, file: Column, by: list[str]) -> DataFrame:
    """Files and records per group, in one pass."""
    return df.groupBy(*by).agg(F.count_distinct(file).alias("files"), F.count("*").alias("records"))


def sample_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def write_layer(
    df: DataFrame, path: str, partitions: list[str], sort: list[str] | None = None, mode: str = "append"
) -> None:
    """Write a layer partitioned on disk.

    The rebalance step merges small pieces and splits a partition that is far larger than
    the others before the write.
    """
    out = df.hint("rebalance", *[F.col(c) for c in partitions])
    if sort:
        out = out.sortWithinPartitions(*partitions, *sort)
    out.write.mode(mode).partitionBy(*partitions).parquet(path)


def save_layer_table(
    df: DataFrame, name: str, layer: str, partitions: list[str], mode: str = "append"
) -> None:
    """Write a layer as a catalogue table tagged with its quality level."""
    spark = df.sparkSession
    df.hint("rebalance", *[F.col(c) for c in partitions]).write.mode(mode).partitionBy(*partitions).format(
        "parquet"
    ).saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('quality' = '{layer}')")


def append_jsonl(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Append postings as JSON lines, one folder per partition value, with one file in it unless it gets far more than others."""
    df.hint("rebalance", *[F.col(c) for c in partitions]).write.mode("append").partitionBy(*partitions).json(path)


_BLANKS = " \t\r\n"


def array_elements(df: DataFrame, value: str = "value") -> DataFrame:
    """One row per element of a text that holds a JSON array; other texts, broken arrays among them, stay as they are."""
    line = F.array(F.col(value))
    elements = F.coalesce(F.from_json(F.col(value), "array<string>"), line)
    is_array = F.startswith(F.ltrim(F.col(value), F.lit(_BLANKS)), F.lit("["))
    others = [c for c in df.columns if c != value]
    return df.select(*others, F.explode(F.when(is_array, elements).otherwise(line)).alias(value)).filter(F.col(value).isNotNull())


def array_files(lines: DataFrame) -> list[str]:
    """Files that hold one array printed over several lines: the first line that is not blank opens an array and does not end it.

    ``lines`` has value, source_file and _block, the place of the line's split in its file. One row per file comes back.
    """
    opens = F.startswith(F.ltrim(F.col("value"), F.lit(_BLANKS)), F.lit("[")) & F.from_json("value", "array<string>").isNull()
    placed = lines.select("source_file", opens.alias("opens"), F.struct("_block", F.monotonically_increasing_id()).alias("place"))
    firsts = placed.groupBy("source_file").agg(F.min_by("opens", "place").alias("opens")).filter("opens")
    return [row["source_file"] for row in firsts.collect()]


def bronze_lines(spark: SparkSession, root: str, domain: str, stream: bool = False) -> DataFrame:
    """Lines of the files of a domain with their lineage, for ``bronze_rows``."""
    read = ingest_text_stream if stream else read_text_lines
    lines = filter_source_files(read(spark, root, domain_glob(domain)), domain).filter(F.trim("value") != "")
    return with_lineage(lines.withColumn("_block", F.col("_metadata.file_block_start")))


def bronze_rows(lines: DataFrame) -> DataFrame:
    """Bronze rows from lines: parsed fields, rescued data and lineage.

    A line holds one posting or an array of postings. Files that hold an array over several lines are found by their first line
    and read whole, each by one task; a broken one is one corrupt row. All other files are read by line, however
    large they are. Looking for array files is an action; in a stream it concerns the files of a micro-batch.
    """
    arrays = array_files(lines)
    rows = lines.drop("_block")
    if arrays:
        # The names are on the driver already, so lines are told apart without a join.
        whole = lines.sparkSession.read.text([unquote(x) for x in arrays], wholetext=True)
        rows = rows.filter(~F.col("source_file").isin(arrays)).unionByName(with_lineage(whole))
    return with_rescued(array_elements(rows), schemas.RAW_POSTING).select(*schemas.BRONZE)


def read_bronze(spark: SparkSession, root: str, domain: str) -> DataFrame:
    """Bronze rows of one domain. Streams take ``bronze_lines`` and make rows of each micro-batch."""
    return bronze_rows(bronze_lines(spark, root, domain))
