"""Near duplicates by SimHash with bit-sliced comparison.

Words are runs of anything but ASCII white space, lower-cased from A to Z, taken in shingles of three with repeats. A bit
of the fingerprint is set if over half of the shingle hashes have it.

Fingerprints within ``RADIUS`` bits are found exactly. With ``RADIUS`` + 2 blocks of bits two such fingerprints agree on
two blocks at least, so every distinct fingerprint goes to one bucket per pair of blocks. A bucket is compared bit-sliced:
bit planes are stored vertically, 64 fingerprints to a word, distances of a query to all of them grow in carry-save
counters, and queries whose whole block has passed the radius are abandoned between planes. A bucket larger than
``CELL`` is dealt into parts and every pair of parts meets in a task of its own, so no task holds more than two parts.
Matches are joined to components inside a task, which emits at most one edge per fingerprint instead of all pairs;
components of all edges follow by alternating stars.

Equal texts share a fingerprint and are compared once, however many there are. Documents without words, null texts among
them, have fingerprint zero and are linked like any other. Rows that share a ``doc_id`` are all reported; where rows are dropped,
they are told apart by their texts. A component without any ``doc_id`` has a null id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import aside, hex16, materialize, text_or_empty, with_row_id
from jobstrata.llm.components import components
from jobstrata.llm.votes import majority, vote_sums
from jobstrata.operators.joins import attach_lookup, in_both
from jobstrata.operators.select import per_key

SHINGLE = 3
RADIUS = 2
CELL = 16_384
_BATCH = 256  # queries that are compared at once
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _row_key() -> Column:
    """What tells rows apart: the id, if any, and the text."""
    text = F.coalesce(F.xxhash64("text").cast("string"), F.lit(""))
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.when(F.col("text").isNotNull(), text).otherwise(""))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """doc_id and fingerprint (long) of every row, with ``row_key`` if asked for."""
    words = F.filter(F.split(F.translate(text_or_empty(), _UPPER, _UPPER.lower()), r"[ \t-\r]+"), lambda w: w != "")
    more = [_row_key().alias("row_key")] * keyed
    rows = with_row_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("row_id", "doc_id", *more, words.alias("words"))
    own = ["row_id", "doc_id"] + ["row_key"] * keyed
    last = F.greatest(F.size("words") - shingle, F.lit(0))
    # A text without words keeps a row with a null place, whose hash is null too.
    places = F.explode_outer(F.when(F.size("words") > 0, F.sequence(F.lit(0), last)))
    each = rows.select(*own, "words", places.alias("place"))
    joined = F.array_join(F.slice("words", F.col("place") + 1, F.lit(shingle)), " ")
    hashed = each.select(*own, F.when(F.col("place").isNotNull(), F.xxhash64(joined)).alias("h"))
    votes = hashed.groupBy(*own).agg(F.count("h").alias("n"), *vote_sums(F.col("h")))
    return votes.select(*own[1:], majority(F.col("n")).alias("fingerprint"))


# Bit-sliced comparison.


def planes(prints: np.ndarray) -> np.ndarray:
    """64 x words matrix: word w of plane b holds bit b of fingerprints 64 w to 64 w + 63."""
    padded = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the counters exceed the radius: a comparison with a constant, from the highest bit down."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def within(prints: np.ndarray, sliced: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (query, match) within the radius, for all queries against a sliced block, batch by batch."""
    levels = max(2, (radius + 1).bit_length())
    full = np.uint64(2**64 - 1)
    for start in range(0, len(queries), _BATCH):
        rows = np.arange(start, min(start + _BATCH, len(queries)))
        shape = (len(rows), sliced.shape[1])
        counters = [np.zeros(shape, np.uint64) for _ in range(levels)]
        over = np.zeros(shape, np.uint64)
        for bit in range(0, 64, 2):
            flips = [np.where(queries[rows] >> np.uint64(bit + k) & np.uint64(1), full, np.uint64(0)) for k in (0, 1)]
            x, y = (sliced[bit + k][None, :] ^ flips[k][:, None] for k in (0, 1))
            # A full adder takes in two planes at once; its carry goes up the counters.
            half = x ^ y
            carry = (x & y) | (counters[0] & half)
            counters[0] ^= half
            for k in range(1, levels):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
            if bit % 8 == 6:
                alive = ~((over | _above(counters, radius)) == full).all(1)
                if not alive.all():
                    rows, over, counters = rows[alive], over[alive], [c[alive] for c in counters]
                    if not len(rows):
                        break
        if len(rows):
            near = ~(over | _above(counters, radius))
            found = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little", count=len(prints))
            query, match = np.nonzero(found)
            yield rows[query], match


def _roots(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of linked pairs; the least index of a set is its root."""
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := parent[parent], parent):
            parent = up


def link_block(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint of one bucket or cell, the index of the least one it is linked to."""
    parent = np.arange(len(prints))
    sliced = planes(prints)
    for a, b in within(prints, sliced, prints, radius):
        parent = _roots(parent, a[a != b], b[a != b])
    return parent


def _link(radius: int):
    """Edges from each fingerprint to its local root, over rows sorted by bucket."""

    def link(prints: np.ndarray, groups: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        sizes = np.diff(np.append(starts, len(groups)))
        left, right = [prints[:0]], [prints[:0]]
        own = np.repeat(sizes, sizes)
        # Small buckets side by side: each row with the next ones of its bucket.
        for lag in range(1, 8):
            a = np.flatnonzero((own <= 8) & (np.arange(len(own)) + lag < np.repeat(starts + sizes, sizes)))
            near = np.bitwise_count(prints[a] ^ prints[a + lag]) <= radius
            left.append(prints[a[near]])
            right.append(prints[a[near] + lag])
        for start, size in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist()):
            block = prints[start : start + size]
            root = link_block(block, radius)
            moved = root != np.arange(size)
            left.append(block[moved])
            right.append(block[root[moved]])
        arrays = [pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_prints, held_groups = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            prints = np.concatenate([held_prints, batch.column("fingerprint").to_numpy().view(np.uint64)])
            groups = np.concatenate([held_groups, batch.column("cell").to_numpy()])
            # The last bucket may go on in the next batch; a cell bounds what waits.
            cut = int(np.flatnonzero(groups == groups[-1])[0]) if len(groups) else 0
            if cut:
                yield link(prints[:cut], groups[:cut])
            held_prints, held_groups = prints[cut:], groups[cut:]
        if len(held_prints):
            yield link(held_prints, held_groups)

    return run


def _buckets(distinct: DataFrame, radius: int) -> DataFrame:
    """fingerprint and bucket: the number of a pair of blocks and the bits in both."""
    blocks = radius + 2
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = [
        F.struct(F.lit(number).alias("pair"), F.col("fingerprint").bitwiseAND(F.lit(signed[i] | signed[j])).alias("bits"))
        for number, (i, j) in enumerate(combinations(range(blocks), 2))
    ]
    return distinct.select("fingerprint", F.explode(F.array(*keys)).alias("key")).select("fingerprint", "key.pair", "key.bits")


def edges(distinct: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect what is within the radius, given distinct fingerprints."""
    rows = _buckets(distinct, radius)
    shared = rows.groupBy("pair", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    met = attach_lookup(in_both(rows, shared, ["pair", "bits"]), shared, ["pair", "bits"], ["n"])
    parts = F.ceil(F.col("n") / cell).cast("int")
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    met = met.withColumn("parts", parts).withColumn("part", part)
    dealt = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = dealt.select("fingerprint", F.xxhash64("pair", "bits", F.least("part", "other"), F.greatest("part", "other")).alias("cell"))
    return cells.repartition("cell").sortWithinPartitions("cell", "fingerprint").mapInArrow(_link(radius), "a long, b long")


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """fingerprint, root and component_id (the least doc_id reachable) of every distinct fingerprint."""
    distinct = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(edges(distinct, radius)).select(F.col("node").alias("fingerprint"), "root")
    rooted = attach_lookup(distinct, roots, ["fingerprint"], ["root"])
    rooted = rooted.withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return attach_lookup(rooted, least, ["root"], ["component_id"]).select("fingerprint", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the least doc_id reachable) of every row."""
    prints = materialize(fingerprints(docs, shingle), "simhash")
    out = attach_lookup(prints, _classes(prints, radius), ["fingerprint"], ["component_id"])
    return out.select("doc_id", hex16("fingerprint").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component: the one of the least doc_id, or of any without an id.

    Rows are told apart by id and text, so a row that shares its id with a linked one stays if it is not linked itself, and of
    rows with equal id and text one stays.
    """
    prints = materialize(fingerprints(docs, shingle, keyed=True), "simhash")
    rooted = attach_lookup(prints, _classes(prints, radius), ["fingerprint"], ["root"])
    rows = rooted.groupBy("root", "doc_id", "row_key").agg(F.count("*").alias("n"))
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first"))
    marked = attach_lookup(rows, first.select("root", F.col("first.row_key").alias("first")), ["root"], ["first"])
    marks = marked.select("row_key", (F.col("row_key") != F.col("first")).alias("gone"), "n").filter("gone OR n > 1")
    marks = materialize(marks.select(F.col("row_key").alias("_row_key"), F.col("gone").alias("_row_gone")), "marks")
    columns = docs.columns
    docs, back = aside(docs, ("_row_key", "_row_gone"))
    keyed = docs.withColumn("_row_key", _row_key())
    out = attach_lookup(keyed, marks, ["_row_key"], ["_row_gone"]).filter("_row_gone IS NULL").select(*docs.columns)
    twice = marks.filter("NOT _row_gone")
    if not twice.isEmpty():
        order = [F.xxhash64(*[x for x, kind in docs.dtypes if not kind.startswith("map")])]
        out = out.unionByName(per_key(in_both(keyed, twice, ["_row_key"]), ["_row_key"], order, 1).select(*docs.columns))
    return out.withColumnsRenamed(back).select(*columns)
