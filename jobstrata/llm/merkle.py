"""Merkle manifest of a dataset by a butterfly exchange.

Every row is a leaf, every group of rows a tree of fanout ``FANOUT`` over its leaves in order, and the subtree roots, in the
order of their groups, are the leaves of one more tree. Trees are cut into aligned blocks of ``FANOUT ** depth`` leaves. A
block hashes its own subtree. Then blocks go through rounds: in each, the blocks whose numbers differ in one digit to the
base ``FANOUT`` swap the roots of what they have hashed so far, and every one of them hashes the parent for itself. After the
last round each block holds the root and all siblings above it, so proofs are read off without a pass back down. A subtree
that is cut short at the end of a group has fewer blocks than its neighbours; its blocks then serve several of theirs.

A round moves at most ``FANOUT`` short rows per block. Ranks come from a range sort with a row number as its last key and
one count per sorted part, so neither a hot group nor one row repeated any number of times gathers in a task. A block's
members are bounded, whatever the texts: they hold digests only.

A null value counts as ``-``; null groups form the first tree, null ids come first in it. Rows of one id are ordered by
their leaf digests; equal rows are leaves of their own, next to each other. A lone leaf is its tree's root. Texts of any
length are hashed in place and never shuffled. An empty table has no leaf and no root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.llm.common import crc_rest, materialize
from jobstrata.operators.joins import attach_lookup

FANOUT = 8
LEVELS = 3
# The columns of a leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_PATH = "positions array<int>, siblings array<array<string>>"


def combine(nodes: list[str]) -> str:
    """Digest of nodes in a row, each as hex text."""
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """Digest of values, each as its length in UTF-8, a colon and itself, a null as ``-``."""
    texts = [value.cast("string") for value in values]
    framed = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.sha2(F.concat(*framed), 256)


def group_key(column: str) -> Column:
    """A key that is never null and sorts nulls first, other values by their bytes."""
    return F.coalesce(F.concat(F.lit("+"), F.col(column).cast("string")), F.lit(""))


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Leaves with ``place`` (from 0, within ``tree``) and ``tree_size``."""
    keys = ["tree", *order, "_row"]
    numbered = leaves.withColumn("_row", F.monotonically_increasing_id())
    in_order = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
    placed = materialize(in_order.withColumn("at", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # One row per sorted part and tree: bounded by the number of parts for each tree.
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "tree", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("tree_size")
    )
    out = attach_lookup(placed, offsets, ["tree", "part"], ["first", "before", "tree_size"])
    return out.withColumn("place", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def levels(leaves: list[str], whole: bool, depth: int = LEVELS) -> list[list[str]]:
    """All levels of a block: up to one node for a whole tree, ``depth`` steps for a part of one."""
    out = [leaves]
    while len(out[-1]) > 1 if whole else len(out) <= depth:
        below = out[-1]
        out.append([combine(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch, one at a time in Python."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def blocks(leaves: DataFrame, order: list[str], carried: list[str], depth: int = LEVELS) -> DataFrame:
    """One row per block: tree, block, n_blocks, members (place, leaf and ``carried``, in order) and node, its root."""
    size = FANOUT**depth

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [levels([x["leaf"] for x in row["members"]], row["n_blocks"] == 1, depth)[-1][0] for row in _each(batch)]
            yield batch.append_column("node", pa.array(nodes, pa.string()))

    rows = ranked(leaves, order).withColumn("block", F.floor(F.col("place") / size))
    member = F.struct("place", "leaf", *carried)
    grouped = rows.groupBy("tree", "block").agg(
        F.ceil(F.max("tree_size") / size).alias("n_blocks"), F.sort_array(F.collect_list(member)).alias("members")
    )
    kind = dict(grouped.dtypes)["members"]
    return materialize(grouped.mapInArrow(roots, f"tree string, block long, n_blocks long, members {kind}, node string"), "blocks")


def _round(state: DataFrame, number: int) -> DataFrame:
    """One exchange: every block gets the roots of its parent's other children and hashes the parent."""
    width = FANOUT**number
    at = F.col("block")
    nodes = F.ceil(F.col("n_blocks") / width)
    child = F.floor(at / width)
    parent = F.floor(child / FANOUT)
    size = lambda c: F.least(F.lit(width), F.col("n_blocks") - c * width)
    sent = state.withColumn("_child", child).withColumn("_low", at % width).withColumn("_step", size(child))
    sent = sent.withColumn("_to", F.explode(F.sequence(parent * FANOUT, F.least(parent * FANOUT + FANOUT - 1, nodes - 1))))
    # A cut-off subtree has _step blocks; each serves every _step-th block of the others.
    served = F.when(F.col("_low") < size(F.col("_to")), F.sequence("_low", size(F.col("_to")) - 1, "_step"))
    sent = sent.withColumn("_served", F.explode(served))
    own = F.when(F.col("_to") == F.col("_child"), F.struct("positions", "siblings"))
    messages = sent.select(
        "tree", "n_blocks", (F.col("_to") * width + F.col("_served")).alias("block"),
        F.struct((F.col("_child") % FANOUT).cast("int").alias("position"), "node").alias("message"), own.alias("own"),
    )
    met = messages.groupBy("tree", "block", "n_blocks").agg(
        F.sort_array(F.collect_list("message")).alias("run"), F.first("own", ignorenulls=True).alias("own")
    )
    position = (child % FANOUT).cast("int")
    others = F.transform(F.filter("run", lambda x: x["position"] != position), lambda x: x["node"])
    parent_node = F.sha2(F.array_join(F.transform("run", lambda x: x["node"]), ""), 256)
    done = nodes == 1
    return met.select(
        "tree", "block", "n_blocks",
        F.when(done, F.col("run")[0]["node"]).otherwise(parent_node).alias("node"),
        F.when(done, F.col("own.positions")).otherwise(F.concat("own.positions", F.array(position))).alias("positions"),
        F.when(done, F.col("own.siblings")).otherwise(F.concat("own.siblings", F.array(others))).alias("siblings"),
    )


def exchange(made: DataFrame) -> DataFrame:
    """tree, block, n_blocks, node (the tree's root) and the path above each block: positions and siblings per level."""
    state = made.select(
        "tree", "block", "n_blocks", "node",
        F.array().cast("array<int>").alias("positions"), F.array().cast("array<array<string>>").alias("siblings"),
    )
    most = made.agg(F.max("n_blocks")).first()[0] or 0
    number = 0
    while most > FANOUT**number:
        state = materialize(_round(state, number), "round")
        number += 1
    return state


def inner_paths(leaves: list[str], whole: bool, depth: int = LEVELS) -> list[tuple[list[int], list[list[str]]]]:
    """Positions and siblings of every leaf inside its block, from the leaf up."""
    nodes = levels(leaves, whole, depth)[:-1]
    out = []
    for at in range(len(leaves)):
        positions, siblings, i = [], [], at
        for level in nodes:
            first = i - i % FANOUT
            run = level[first : first + FANOUT]
            positions.append(i - first)
            siblings.append(run[: i - first] + run[i - first + 1 :])
            i //= FANOUT
        out.append((positions, siblings))
    return out


def fold(node: str, positions: list[int], siblings: list[list[str]]) -> str:
    """Root that a node and its path lead to."""
    for position, others in zip(positions, siblings):
        node = combine([*others[:position], node, *others[position:]])
    return node


def paths(made: DataFrame, state: DataFrame, carried: str, depth: int = LEVELS) -> DataFrame:
    """One row per leaf: leaf, the ``carried`` column, positions and siblings up to its tree's root."""
    joined = attach_lookup(made.select("tree", "block", "n_blocks", "members"), state, ["tree", "block"], ["positions", "siblings"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each(batch):
                members = row["members"]
                found = inner_paths([x["leaf"] for x in members], row["n_blocks"] == 1, depth)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["leaf"] for x in members], pa.string()),
                        pa.array([x[carried] for x in members], pa.string()),
                        pa.array([p + row["positions"] for p, _ in found], pa.list_(pa.int32())),
                        pa.array([s + row["siblings"] for _, s in found], pa.list_(pa.list_(pa.string()))),
                    ],
                    ["leaf", carried, "positions", "siblings"],
                )

    return joined.mapInArrow(run, f"leaf string, {carried} string, {_PATH}")


def manifest(leaves: DataFrame, depth: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Blocks of the trees of ``leaves`` (tree, doc_id, leaf, altered) and what stands above each block.

    The second frame has tree, block, subroot, root, positions and siblings up to the root over all trees, and ``depth``,
    the levels that lie within the block's own tree.
    """
    made = blocks(leaves, ["doc_id", "leaf"], ["doc_id", "altered"], depth)
    state = exchange(made)
    subroots = state.filter("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("node").alias("leaf"))
    top = blocks(subroots, ["name"], ["name"], depth)
    top_state = exchange(top)
    root = top_state.filter("block = 0").select("node").first()
    over = paths(top, top_state, "name", depth).select(
        F.col("name").alias("tree"), F.col("positions").alias("over_positions"), F.col("siblings").alias("over_siblings")
    )
    above = attach_lookup(state, over, ["tree"], ["over_positions", "over_siblings"])
    above = above.select(
        "tree", "block", F.col("node").alias("subroot"), F.lit(root and root["node"]).cast("string").alias("root"),
        F.concat("positions", "over_positions").alias("positions"), F.concat("siblings", "over_siblings").alias("siblings"),
    )
    return made, materialize(above, "above")


def leaves_of(docs: DataFrame, tampered: Column) -> DataFrame:
    """tree, doc_id, leaf and altered: the leaf of the row with a lower-cased text where ``tampered`` holds, else null."""
    values = [F.col(x) for x in LEAF_COLUMNS]
    # Letters A to Z only; other capitals stay.
    lowered = F.translate(F.col("text"), UPPER, UPPER.lower())
    changed = leaf_digest([*values[:-1], lowered])
    return docs.select(
        group_key("lang").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(values).alias("leaf"), F.when(tampered, changed).alias("altered"),
    )


def verify(docs: DataFrame, tampered: Column, depth: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: its proof, and the root that its leaf, tampered with or not, folds to.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    made, above = manifest(materialize(leaves_of(docs, tampered), "leaves"), depth)
    joined = attach_lookup(made.select("tree", "block", "n_blocks", "members"), above, ["tree", "block"], ["subroot", "root", "positions", "siblings"])
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each(batch):
                rest = "".join(x for level in row["siblings"] for x in level)
                rows = []
                members = row["members"]
                found = inner_paths([x["leaf"] for x in members], row["n_blocks"] == 1, depth)
                for member, (positions, siblings) in zip(members, found):
                    inner = "".join(x for level in siblings for x in level)
                    proof = hashlib.sha256((inner + rest).encode()).hexdigest()
                    node = fold(member["altered"] or member["leaf"], positions + row["positions"], siblings + row["siblings"])
                    rows.append((member["doc_id"], member["leaf"], row["subroot"], row["root"], proof, node, node == row["root"]))
                types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    kinds = ["long", *["string"] * 5, "boolean"]
    return joined.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, kinds)))


def third_of_ids(column: str = "doc_id") -> Column:
    """Rows whose unsigned crc32 of the decimal id 3 divides; not those without an id."""
    return F.coalesce(crc_rest(column, 3) == 0, F.lit(False))
