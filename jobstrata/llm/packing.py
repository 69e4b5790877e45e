"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces of the greatest length allowed and of the powers of two in the binary form of
what is left, in falling order. Every piece is a sequence of its own and its length names its bucket, so all sequences of
a bucket are equally long, none crosses a document and none needs padding: batches are drawn from one bucket at a time.

A null or empty text is the end token alone, one piece of length 1. A document of any length is cut in the task that
encodes it. Repeated rows are packed each on their own. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.bpe import SEGMENT, encoder
from jobstrata.llm.common import slices, text_or_empty

LONGEST = 4096
END = 2


def binary_lengths(n: int, longest: int = LONGEST) -> Iterator[int]:
    """Lengths of the pieces of n tokens; ``longest`` is a power of two."""
    for _ in range(n // longest):
        yield longest
    rest, power = n % longest, longest >> 1
    while rest:
        if rest >= power:
            yield power
            rest -= power
        power >>= 1


def pieces(docs: DataFrame, path: str, longest: int = LONGEST, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, its ids."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in slices(batches, "text", SEGMENT):
            rows: list[tuple] = []
            for key, ids in zip(part.column("doc_id").to_pylist(), own.encode_all(part.column("text"))):
                ids = np.append(ids, np.int32(end)).astype("<u4")
                at = 0
                for length in binary_lengths(len(ids), longest):
                    own_ids = ids[at : at + length]
                    row = (key, at, length, zlib.crc32(own_ids.tobytes()), len(ids))
                    rows.append(row + ((own_ids,) if with_ids else ()))
                    at += length
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, names)


def pack(docs: DataFrame, path: str, longest: int = LONGEST, end: int = END, with_ids: bool = False) -> DataFrame:
    """Pieces with their sequence: sequence_id, offset (always 0) and bucket (the length all its sequences share).

    A sequence number is the task and the place in it, so numbering takes no shuffle and a rerun task numbers alike.
    """
    rows = pieces(docs, path, longest, end, with_ids)
    return rows.select(
        *rows.columns,
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.col("length").alias("bucket"),
    )


def buckets(packed: DataFrame) -> DataFrame:
    """Sequences and tokens per bucket: what a sampler over buckets draws from."""
    return packed.groupBy("bucket").agg(F.count("*").alias("sequences"), F.sum("length").alias("tokens"))
