"""Exact duplicates by composable polynomial fingerprints and a chunkwise comparison of what they join.

A text is normalised, cut into chunks of ``CHUNK`` bytes and each chunk is hashed on its own as a polynomial over two
prime fields. Chunk hashes compose by length-shifted arithmetic, ``h(ab) = h(a) * r**len(b) + h(b)``, so the chunks of a
huge document are hashed side by side and in any grouping. Rows with equal fingerprints and lengths are then compared
chunk by chunk: per chunk, the least and the greatest text are kept, which are equal if all are. That comparison is an
aggregate with partial results in every task, so a fingerprint that holds a third of all rows moves one row per task,
and no task ever holds a whole group.

Null texts count as empty. Rows are told apart by content and place, not by ``doc_id``: repeated rows stay repeated rows
of the result, and the keeper among rows of one ``doc_id`` is the longest original. A null ``doc_id`` comes last in ties.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import SPACES, materialize, text_or_empty
from jobstrata.operators.joins import attach_lookup, in_both

# Two primes below 2**31 and the base of the polynomial in each field, two bases per prime.
FIELDS = ((2147483647, 1103515245), (2147483647, 742938285), (2147483629, 1299709131), (2147483629, 950706376))
CHUNK = 4096
# Bytes of one chunk in the comparison of texts.
COMPARED = 1 << 16

_PRIMES = np.array([p for p, _ in FIELDS], dtype=np.int64)


def _powers() -> np.ndarray:
    """r**(CHUNK-1) ... r**0 per field, as doubles: a chunk's sum stays below 2**51 and is exact."""
    out = np.empty((CHUNK, len(FIELDS)))
    for k, (p, r) in enumerate(FIELDS):
        value = 1
        for i in range(CHUNK - 1, -1, -1):
            out[i, k] = value
            value = value * r % p
    return out


_POWERS = _powers()


def compose(left: tuple[int, ...], right: tuple[int, ...], right_bytes: int) -> tuple[int, ...]:
    """Fingerprint of two strings in a row, from their fingerprints and the length of the second."""
    return tuple((a * pow(r, right_bytes, p) + b) % p for a, b, (p, r) in zip(left, right, FIELDS))


def polynomial(data: bytes) -> tuple[int, ...]:
    """Fingerprint of a byte string. Bytes count from 1, and the empty string is all zeros."""
    values = np.frombuffer(data, np.uint8)
    whole = len(values) // CHUNK
    total: tuple[int, ...] = (0,) * len(FIELDS)
    # Blocks of chunks bound what is held as doubles beside the text.
    for start in range(0, whole, 1024):
        stop = min(start + 1024, whole)
        block = values[start * CHUNK : stop * CHUNK].astype(np.float64).reshape(-1, CHUNK) + 1
        for row in ((block @ _POWERS).astype(np.int64) % _PRIMES).tolist():
            total = compose(total, tuple(row), CHUNK)
    rest = values[whole * CHUNK :]
    if len(rest):
        tail = ((rest.astype(np.float64) + 1) @ _POWERS[CHUNK - len(rest) :]).astype(np.int64) % _PRIMES
        total = compose(total, tuple(tail.tolist()), len(rest))
    return total


def _normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(None, SPACES)


def _key(fingerprint: tuple[int, ...], size: int) -> str:
    return "".join(f"{part:08x}" for part in fingerprint) + f"-{size:x}"


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, digests = [], []
        for text in batch.column("text"):
            data = _normalised(text.as_py())
            keys.append(_key(polynomial(data), len(data)))
            digests.append(hashlib.sha256(data).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_points"), pa.array(keys, pa.string()), pa.array(digests, pa.string())],
            ["doc_id", "n_points", "fingerprint", "text_sha256"],
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_points (code points of the original), fingerprint and text_sha256 of every row, in one pass of the scan."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_points"), "text")
    return rows.mapInArrow(_prints, "doc_id long, n_points long, fingerprint string, text_sha256 string")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple[str, int, bytes]] = []
        for text in batch.column("text"):
            data = _normalised(text.as_py())
            key = _key(polynomial(data), len(data))
            rows += [(key, number, data[at : at + COMPARED]) for number, at in enumerate(range(0, len(data), COMPARED))]
        # An output batch holds at most 512 chunks (32 MB).
        for start in range(0, len(rows), 512):
            keys, numbers, chunks = zip(*rows[start : start + 512])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(numbers, pa.int64()), pa.array(chunks, pa.binary())],
                ["fingerprint", "chunk_no", "chunk"],
            )


def unequal(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """Fingerprints of ``shared`` whose texts differ in any chunk; no row if the fingerprints tell the truth."""
    chunks = docs.select(text_or_empty().alias("text")).mapInArrow(_chunks, "fingerprint string, chunk_no long, chunk binary")
    compared = in_both(chunks, shared, ["fingerprint"]).groupBy("fingerprint", "chunk_no")
    ends = compared.agg(F.min("chunk").alias("least"), F.max("chunk").alias("greatest"))
    return ends.filter(F.col("least") != F.col("greatest")).select("fingerprint").distinct()


def find_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in the original stays, of those the smallest doc_id. Should several
    rows share that doc_id and length, each of them counts as kept, as nothing tells them apart.
    """
    prints = materialize(fingerprints(docs), "prints")
    shared = prints.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1")
    broken = materialize(unequal(docs, shared), "unequal").withColumn("differs", F.lit(True))
    keyed = attach_lookup(prints, broken, ["fingerprint"], ["differs"])
    # Texts that differ under one fingerprint form groups of their own, told apart by their digests.
    keyed = keyed.withColumn("text_key", F.concat("fingerprint", F.when(F.col("differs"), F.col("text_sha256")).otherwise("")))
    first = F.min(F.struct((-F.col("n_points")).alias("rank"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id")))
    groups = keyed.groupBy("text_key").agg(first.alias("first"), F.count("*").alias("group_size"))
    groups = groups.select("text_key", "group_size", F.col("first.id").alias("keep_id"), (-F.col("first.rank")).alias("keep_points"))
    out = attach_lookup(keyed, groups, ["text_key"], ["group_size", "keep_id", "keep_points"])
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id of the rows that stay."""
    return find_duplicates(docs).filter("kept").select("doc_id")
