"""The manifest against trees built in memory, for blocks of several sizes."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from jobstrata.llm import merkle
from tests.llm import odd


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lowered=False):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    if lowered and values[-1] is not None:
        values[-1] = "".join(c.lower() if "A" <= c <= "Z" else c for c in values[-1])
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(levels, at):
    out = []
    for level in levels[:-1]:
        first = at - at % 8
        run = level[first : first + 8]
        out.append((run[: at - first], run[at - first + 1 :]))
        at //= 8
    return out


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    order = {g: sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for g in names}
    trees = {g: tree([leaf(r) for r in order[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    root, out = top[-1][0], []
    for k, g in enumerate(names):
        for i, row in enumerate(order[g]):
            steps = path(trees[g], i) + path(top, k)
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
            node = leaf(row, hit)
            for before, after in steps:
                node = digest(*before, node, *after)
            proof = digest(*[x for before, after in steps for x in before + after])
            out.append((row["doc_id"], leaf(row), trees[g][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def found(docs, depth):
    return sorted((tuple(r) for r in merkle.verify(docs, merkle.third_of_ids(), depth).collect()), key=repr)


@pytest.mark.parametrize("depth", [0, 1, merkle.LEVELS])
def test_odd_rows(spark, depth):
    docs = odd.frame(spark)
    assert found(docs, depth) == plain(docs.collect())


@pytest.mark.parametrize("n, depth", [(1, 0), (8, 0), (9, 0), (65, 0), (73, 0), (513, 1), (600, 0), (600, 1)])
def test_ragged_rounds(spark, n, depth):
    """One large group beside small ones: cut-off subtrees at every round."""
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"), F.lit("s").alias("source"),
        F.when(F.col("id") % 37 != 5, "en").otherwise(F.when(F.col("id") % 2 == 0, "é")).alias("lang"), F.lit(7).alias("n_chars"),
    )
    assert found(docs, depth) == plain(docs.collect())


def test_many_trees(spark):
    docs = spark.range(90).selectExpr("id doc_id", "'T' text", "'s' source", "concat('l', id % 70) lang", "1L n_chars")
    assert found(docs, 0) == plain(docs.collect())


def test_one_row_many_times(spark):
    docs = spark.range(200).selectExpr("1L doc_id", "'T' text", "'s' source", "'x' lang", "1L n_chars")
    rows = found(docs, 1)
    assert rows == plain(docs.collect()) and len(rows) == 200


def test_empty(spark):
    assert found(odd.empty(spark), merkle.LEVELS) == []


def test_a_round_serves_every_block_once(spark):
    """Also where the last subtree has fewer blocks than its neighbours."""
    for n in (1, 7, 8, 9, 20, 64, 65, 130):
        state = spark.range(n).selectExpr(
            "'' tree", "id block", f"{n}L n_blocks", "cast(id as string) node", "cast(array() as array<int>) positions",
            "cast(array() as array<array<string>>) siblings",
        )
        for number in range(3):
            if n > 8**number:
                state = merkle._round(state, number)
        rows = state.collect()
        assert sorted(r["block"] for r in rows) == list(range(n)) and len({r["node"] for r in rows}) == 1
