"""Alignment of two tokenizers over the same text by pointer jumping.

A text is encoded by a byte-level vocabulary (A) and by a vocabulary of pieces (B). Every token of either points to the token
of the other side that overlaps it and reaches farthest right, or to itself if none reaches farther; of two that end together
the one of A is the end. Doubling the pointers, all tokens of a batch at once, takes every token to the last one of its
component. Components are the groups of tokens between byte offsets where both sides end.

Both sides begin a token at every lone blank, so texts are cut there into units, and each distinct unit of a batch is encoded
and aligned once. Token pairs that overlap are links. Texts are taken in blocks of about ``BLOCK`` bytes. A block counts how
many of its documents hold each pair, and only these counts are shuffled and added up over the corpus. The totals of a
block's pairs then come back to it in one list, bounded by the block, and are summed per unit and per document. Pairs that
occur everywhere cost one short row per block; the highest count per A id is a table of at most one row per id of A.

Null and empty texts have no tokens, nor have texts whose joined token bytes differ from a blank and the text (such as those
that hold the character B writes for a blank). Strings of special tokens are plain text. A text of any length is a block by
itself at most, and what is kept of it are the numbers of its units. Repeated rows count each on their own. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from jobstrata.llm.bpe import _byte_letters, _ragged
from jobstrata.llm.common import materialize, slices, text_or_empty
from jobstrata.operators.joins import attach_lookup

BLOCK = 1 << 20
# A pair is the A id times this plus the B id.
SHIFT = 1 << 16
# Fixed value: the pattern that byte-level vocabularies of this kind split texts by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BLANK = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
# A blank between two characters that are none.
_CUT = re.compile(r"(?<=[^ ]) (?=[^ ])")


class Tokens:
    """The bytes of every id of a vocabulary, in a row."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(x) for x in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return _ragged(self.starts, self.sizes, self.data, ids)


class Pair:
    """Both vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("this file describes another kind of tokenizer")
        byte = {letter: i for i, letter in enumerate(_byte_letters())}
        vocab = spec["model"]["vocab"]
        special = {x["content"] for x in spec["added_tokens"]}
        ranks = {bytes(byte[x] for x in token): at for token, at in vocab.items() if token not in special}
        by_id = {at: token for token, at in ranks.items()}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_tokens = Tokens([by_id.get(i, b"") for i in range(max(vocab.values()) + 1)])
        self.b = SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(_BLANK in x.lstrip(_BLANK) or x.startswith(2 * _BLANK) and x.strip(_BLANK) for x in pieces):
            raise ValueError("pieces of this vocabulary go across blanks")
        self.b_tokens = Tokens([self._piece(i, x) for i, x in enumerate(pieces)])
        # Every id as decimal digits and a place for the mark behind it.
        numbers = [b"%d," % i for i in range(max(len(self.a_tokens.sizes), len(self.b_tokens.sizes)))]
        self.number_sizes = np.array([len(x) for x in numbers], np.int64)
        self.number_starts = np.cumsum(self.number_sizes) - self.number_sizes
        self.number_data = np.frombuffer(b"".join(numbers), np.uint8)
        if len(self.b_tokens.sizes) > SHIFT:
            raise ValueError("too many pieces")

    def _piece(self, at: int, piece: str) -> bytes:
        found = _BYTE.fullmatch(piece)
        if found and self.b.is_byte(at):
            return bytes([int(found[1], 16)])
        return piece.replace(_BLANK, " ").encode()

    def _encode_a(self, units: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and how many each unit has. Units are encoded in one call, as a blank in front of each keeps them apart."""
        if any(not x or x[0] == " " or x[-1] == " " for x in units):
            return _row([self.a.encode_ordinary(" " + x) for x in units])
        ids = np.array(self.a.encode_ordinary("".join(map(" ".__add__, units))), np.int64)
        ends = np.searchsorted(np.cumsum(self.a_tokens.sizes[ids]), np.cumsum(lengths)) + 1
        return ids, np.diff(ends, prepend=0)

    def encode(self, units: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of A, ids of B (of a blank and each unit), how many of each a unit has, and whether both give its bytes."""
        whole = ("".join(map(" ".__add__, units))).encode()
        lengths = np.fromiter((len(x.encode()) + 1 for x in units), np.int64, len(units))
        sides = []
        for tokens, (ids, sizes) in ((self.a_tokens, self._encode_a(units, lengths)), (self.b_tokens, _row(self.b.encode(units, num_threads=1)))):
            sides.append((ids, sizes, tokens.joined(ids), _sums(tokens.sizes[ids], sizes)))
        good = np.ones(len(units), bool)
        for _, _, data, found in sides:
            if len(data) == len(whole) and data.tobytes() == whole:
                continue
            # Only where something differs, unit by unit.
            ends, stops = np.cumsum(found).tolist(), np.cumsum(lengths).tolist()
            raw = data.tobytes()
            for i, (n, m) in enumerate(zip(found.tolist(), lengths.tolist())):
                good[i] &= raw[ends[i] - n : ends[i]] == whole[stops[i] - m : stops[i]]
        return sides[0][0], sides[1][0], sides[0][1], sides[1][1], good


def _row(coded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists in a row, and their lengths."""
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    return np.fromiter(chain.from_iterable(coded), np.int64, int(sizes.sum())), sizes


def _distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in rising order; sorting beats hashing here."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the runs of the given sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def units_of(text: str) -> list[str]:
    """A text cut at its lone blanks. Both sides begin a token at each of them, so no token and no group goes across."""
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _CUT.split(text)
    return text.split(" ")


@lru_cache(2)
def vocabularies(path_a: str, path_b: str) -> Pair:
    """Both vocabularies, read once per Python worker."""
    return Pair(path_a, path_b)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The last token (a number among those of A) of the component of each token of A, then of each of B.

    Ends are byte offsets, rising and with the same last one on both sides.
    """
    n = len(ends_a)
    # The overlapping token that reaches farthest is the one that holds a token's last byte.
    over_a = np.searchsorted(ends_b, ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    after_a = np.where(ends_b[over_a] > ends_a, n + over_a, np.arange(n))
    # On a tie B points to A, so that a component has one end.
    after = np.concatenate([after_a, over_b])
    while True:
        further = after[after]
        if np.array_equal(further, after):
            return after
        after = further


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that overlap: between two neighbouring ends of either side lies one."""
    ends = _distinct(np.concatenate([ends_a, ends_b]))
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def written(own: Pair, ids: tuple[np.ndarray, np.ndarray], group: tuple[np.ndarray, np.ndarray], sizes: np.ndarray) -> list[str]:
    """The groups of each unit as text: ids of a side joined by commas, sides by a bar, groups by a semicolon.

    ``group`` numbers the group of every token, ``sizes`` the tokens of both sides per unit.
    """
    n_a, n_b = len(ids[0]), len(ids[1])
    last = [np.append(g[1:] != g[:-1], True) for g in group]
    # In front of a token of A stand the tokens of B of earlier groups, in front of one of B those of A up to its own group.
    at_a = np.arange(n_a) + np.searchsorted(group[1], group[0])
    at_b = np.arange(n_b) + np.searchsorted(group[0], group[1], side="right")
    codes = np.empty(n_a + n_b, np.int64)
    marks = np.full(n_a + n_b, ord(","), np.uint8)
    codes[at_a], codes[at_b] = ids
    marks[at_a[last[0]]], marks[at_b[last[1]]] = ord("|"), ord(";")
    data = _ragged(own.number_starts, own.number_sizes, own.number_data, codes).copy()
    data[np.cumsum(own.number_sizes[codes]) - 1] = marks
    text = data.tobytes().decode("ascii")
    ends = np.cumsum(_sums(own.number_sizes[codes], sizes)).tolist()
    # Without the last semicolon of each unit.
    return [text[a : max(a, b - 1)] for a, b in zip([0, *ends], ends)]


def align(own: Pair, units: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Distinct units: n_a, n_b, n_groups, n_links per unit (all 0 where bytes differ), groups as text, links, and which fit.

    Tokens of all units lie in one row, and their pointers are doubled together.
    """
    ids_a, ids_b, n_a, n_b, good = own.encode(units)
    ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
    n_a, n_b = n_a * good, n_b * good
    if not len(ids_a):
        return np.zeros((4, len(units)), np.int64), [""] * len(units), np.zeros(0, np.int64), good
    ends_a, ends_b = np.cumsum(own.a_tokens.sizes[ids_a]), np.cumsum(own.b_tokens.sizes[ids_b])
    label = terminals(ends_a, ends_b)
    # Terminals rise from left to right, so a group is a run of one label.
    text = written(own, (ids_a, ids_b), (label[: len(ids_a)], label[len(ids_a) :]), n_a + n_b)
    at_a, at_b = links(ends_a, ends_b)
    n_groups = _sums(np.append(label[1 : len(ids_a)] != label[: len(ids_a) - 1], True).astype(np.int64), n_a)
    n_links = _sums(np.bincount(at_a, minlength=len(ids_a)), n_a)
    return np.stack([n_a, n_b, n_groups, n_links]), text, ids_a[at_a] * SHIFT + ids_b[at_b], good


_FIELDS = [
    ("doc_id", pa.int64()), ("block", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("units", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32())),
    ("unit_links", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())),
]
ALIGNED = (
    "doc_id long, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "units array<int>, pairs array<long>, holders array<int>, unit_links array<int>, places array<int>"
)


def aligned(docs: DataFrame, path_a: str, path_b: str, groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: its counts, the digest of its groups, and its ``units`` as numbers of its block.

    The first row of a block also has the block's distinct ``pairs``, how many documents of the block hold each, and for every
    unit how many links it has and their ``places`` among the pairs. With ``groups``, the groups themselves follow as text.
    """
    schema = pa.schema(_FIELDS + [("groups", pa.string())] * groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabularies(path_a, path_b)
        for batch in slices(batches, "text", BLOCK):
            number: dict[str, int] = {}
            rows = [[number.setdefault(u, len(number)) for u in units_of(x)] if x else [] for x in batch.column("text").to_pylist()]
            counts, texts, pairs, good = align(own, list(number))
            del number
            n = np.fromiter(map(len, rows), np.int64, len(rows))
            codes = np.fromiter(chain.from_iterable(rows), np.int64, int(n.sum()))
            # A text with a unit whose bytes differ has no tokens.
            fits = _sums(~good[codes], n) == 0
            codes, n = codes[np.repeat(fits, n)], n * fits
            distinct, places = np.unique(pairs, return_inverse=True)
            # Each document counts once for each of its pairs.
            owner = np.repeat(np.arange(len(rows)), n)
            once = _distinct(owner * len(good) + codes)
            some = once % max(1, len(good))
            first = np.cumsum(counts[3]) - counts[3]
            held = _ragged(first, counts[3], places, some) * len(rows) + np.repeat(once // max(1, len(good)), counts[3][some])
            holders = np.bincount(_distinct(held) // max(1, len(rows)), minlength=len(distinct)).astype(np.int32)
            ends = np.cumsum(n).tolist()
            digests, written_out = [], []
            for a, b in zip([0, *ends], ends):
                digest, kept = hashlib.sha256(), []
                for at in range(a, b, 1 << 16):
                    piece = ";" * (at > a) + ";".join([texts[i] for i in codes[at : min(b, at + (1 << 16))].tolist()])
                    digest.update(piece.encode())
                    kept += [piece] * groups
                digests.append(digest.hexdigest() if b > a else "")
                written_out.append("".join(kept))
            lead = [[x] + [None] * (len(rows) - 1) for x in (distinct, holders, counts[3].astype(np.int32), places.astype(np.int32))]
            small = codes.astype(np.int32)
            columns = [
                batch.column("doc_id"), batch.column("row").take(pa.array([0] * len(rows))), *[_sums(counts[k][codes], n) for k in range(4)],
                digests, [small[a:b] for a, b in zip([0, *ends], ends)], *lead, *[written_out] * groups,
            ]
            arrays = [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    # The number of a block is that of its first row.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(run, ALIGNED + ", groups string" * groups)


def pair_counts(made: DataFrame) -> DataFrame:
    """pair, documents (that hold it, over the corpus) and best (whether no pair of its A id has more)."""
    held = made.filter("pairs is not null").select(F.explode(F.arrays_zip("pairs", "holders")).alias("x"))
    counts = held.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.holders").alias("documents"))
    counts = materialize(counts.withColumn("a", F.floor(F.col("pair") / SHIFT)), "pairs")
    # At most one row per id of A.
    most = F.broadcast(counts.groupBy("a").agg(F.max("documents").alias("most")))
    return counts.join(most, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """Rows of a block with their sums over the totals of the block's pairs."""
    order = np.argsort(right.column("pair").to_numpy())
    totals = [right.column("best").to_numpy()[order].astype(np.int64), right.column("documents").to_numpy()[order]]
    head = left.filter(pc.is_valid(left.column("places")))
    sizes, places = (head.column(x).combine_chunks().flatten().to_numpy().astype(np.int64) for x in ("unit_links", "places"))
    units = left.column("units").combine_chunks()
    n, codes = pc.list_value_length(units).to_numpy().astype(np.int64), units.flatten().to_numpy()
    out = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    for name, total in zip(("n_best", "count_sum"), totals):
        # Summed per unit first, then per document.
        out = out.append_column(name, pa.array(_sums(_sums(total[places], sizes)[codes], n), pa.int64()))
    return out.append_column("groups_sha256", left.column("groups_sha256"))


def compare(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``."""
    made = materialize(aligned(docs, path_a, path_b), "aligned")
    wanted = made.filter("pairs is not null").select("block", F.explode("pairs").alias("pair"))
    totals = attach_lookup(wanted, pair_counts(made), ["pair"], ["documents", "best"])
    # A block's places follow the rising order of its pairs.
    totals = totals.withColumnRenamed("block", "of")
    rows = made.drop("pairs", "holders").groupBy("block").cogroup(totals.groupBy("of"))
    names = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.applyInArrow(_scored, names)
