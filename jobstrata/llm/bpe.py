"""Byte-pair encoding and decoding of whole texts with a public vocabulary file.

A word's parts lie side by side in one contiguous array next to the ranks of adjacent parts. The least rank is looked up
by a scan, its boundary deleted and the two neighbouring ranks refreshed, until no pair has a rank. Short words of a
batch do this together, one row each, and every distinct word of a batch is encoded once. Words of over ``SHORT`` bytes
use the same merges from a heap, so one endless word costs n log n.

The file must hold a ``BPE`` model with an end-of-word suffix over byte letters, normalised by NFC, white space and lower
case, as ``word_bpe_49k.json`` does; ``Encoder`` checks that. Its path is a parameter and must exist on every executor.
Special tokens written out in a text are encoded as such, as the tokenizers library does by default.

Null and empty texts have no ids. A text of any length is encoded in segments that end at white space, so memory follows
the segment. Repeated rows are encoded alike, and an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.chars import FIRST_SPECIAL, LETTER, NUMBER, SPECIAL, classes, points_of
from jobstrata.llm.common import slices, text_or_empty

SHORT = 32
SEGMENT = 1 << 23
_NONE = np.int32(2**31 - 1)
_BLANK = re.compile(r"[ \t-\r]")

# The endings that the pattern splits off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {}, 256
    for byte in range(256):
        if byte not in printable:
            letters[byte], extra = chr(extra), extra + 1
    return [letters.get(byte, chr(byte)) for byte in range(256)]


def _ragged(starts: np.ndarray, sizes: np.ndarray, data: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The runs data[starts[c] : starts[c] + sizes[c]] of all codes, one after the other."""
    each = sizes[codes]
    ends = np.cumsum(each)
    if not len(ends) or not ends[-1]:
        return data[:0]
    return data[np.arange(ends[-1]) + np.repeat(starts[codes] - (ends - each), each)]


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not suffix or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError("this file describes another kind of tokenizer")
        vocab = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, at in [*vocab.items(), *self.special.items()]:
            self.tokens[at] = token
        letters = _byte_letters()
        self._inner = np.array([vocab[x] for x in letters], np.int32)
        self._last = np.array([vocab[x + suffix] for x in letters], np.int32)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.uint64)
        right = np.array([vocab[b] for _, b in pairs], np.uint64)
        self._merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self._fill_table((left << np.uint64(32)) | right)
        self._strings = pa.array(self.tokens, pa.string())
        self._numbers = pa.array([str(i) for i in range(len(self.tokens))], pa.string())

    # Pairs and ranks: an open-addressed table that is read for many pairs at once.
    def _fill_table(self, keys: np.ndarray) -> None:
        self._bits = max(10, int(np.ceil(np.log2(4 * max(1, len(keys))))))
        mask = (1 << self._bits) - 1
        self._keys = np.full(mask + 1, np.uint64(2**64 - 1))
        self._ranks = np.full(mask + 1, _NONE)
        slots = self._slot(keys).tolist()
        taken: dict[int, int] = {}
        for rank, (slot, key) in enumerate(zip(slots, keys.tolist())):
            while slot in taken and taken[slot] != key:
                slot = (slot + 1) & mask
            if slot not in taken:
                taken[slot] = key
                self._keys[slot], self._ranks[slot] = key, rank
        self._by_pair = {key: rank for rank, key in reversed(list(enumerate(keys.tolist())))}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or the greatest int; ids below 0 pair with nothing."""
        out = np.full(left.shape, _NONE)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left.ravel()[todo].astype(np.uint64) << np.uint64(32)) | right.ravel()[todo].astype(np.uint64)
        slots, flat = self._slot(keys), out.ravel()
        while len(todo):
            found = self._keys[slots]
            hit = found == keys
            flat[todo[hit]] = self._ranks[slots[hit]]
            on = ~hit & (self._ranks[slots] != _NONE)
            todo, keys, slots = todo[on], keys[on], (slots[on] + 1) & ((1 << self._bits) - 1)
        return flat.reshape(left.shape)

    def _merge_short(self, ids: np.ndarray) -> np.ndarray:
        """Merge all rows of a matrix of parts, filled up with -1 on the right."""
        out = np.full_like(ids, -1)
        rows, width = np.arange(len(ids)), ids.shape[1]
        ranks = np.full(ids.shape, _NONE)
        if width > 1:
            ranks[:, :-1] = self._rank(ids[:, :-1], ids[:, 1:])
        places = np.arange(width)
        while len(ids):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(ids)), at]
            going = best != _NONE
            out[rows[~going]] = ids[~going]
            rows, ids, ranks, at, best = rows[going], ids[going], ranks[going], at[going], best[going]
            if not len(ids):
                break
            # Delete the boundary behind the pair: parts move up from at + 1, ranks from at.
            n = np.arange(len(ids))
            pick = places[None, :] + (places[None, :] > at[:, None])
            padded = np.concatenate([ids, np.full((len(ids), 1), -1, np.int32)], 1)
            ids = np.take_along_axis(padded, pick, 1)
            ids[n, at] = self._merged[best]
            padded = np.concatenate([ranks, np.full((len(ids), 1), _NONE)], 1)
            ranks = np.take_along_axis(padded, places[None, :] + (places[None, :] >= at[:, None]), 1)
            before, after = at - 1, np.minimum(at + 1, width - 1)
            ranks[n, at] = self._rank(ids[n, at], np.where(at + 1 < width, ids[n, after], -1))
            some = before >= 0
            ranks[n[some], before[some]] = self._rank(ids[n[some], before[some]], ids[n[some], at[some]])
        return out

    def _merge_long(self, word: bytes) -> list[int]:
        """One word of any length: ranks wait in a heap, outdated entries are skipped."""
        parts = self._inner[np.frombuffer(word, np.uint8)].tolist()
        parts[-1] = int(self._last[word[-1]])
        size = len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        rank = self._by_pair.get
        heap = [(r, i) for i in range(size - 1) if (r := rank(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= size or rank(parts[i] << 32 | parts[j]) != r:
                continue
            parts[i], parts[j] = int(self._merged[r]), -1
            after[i] = k = after[j]
            if k < size:
                before[k] = i
                if (x := rank(parts[i] << 32 | parts[k])) is not None:
                    heapq.heappush(heap, (x, i))
            if (h := before[i]) >= 0 and (x := rank(parts[h] << 32 | parts[i])) is not None:
                heapq.heappush(heap, (x, h))
        return [x for x in parts if x >= 0]

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct byte strings: how many each has, and all of them in a row."""
        offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"\0", np.uint8)
        sizes = np.diff(offsets)
        counts = np.zeros(len(words), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        first = data[np.minimum(offsets[:-1], len(data) - 1)]
        second = data[np.minimum(offsets[:-1] + 1, len(data) - 1)]
        stands = (sizes == 3) & (first == 0xED) & (second >= 0xA0)
        for row in np.flatnonzero(stands).tolist():
            code = ord(data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "surrogatepass"))
            found.append((np.array([row]), np.array([[list(self.special.values())[code - FIRST_SPECIAL]]], np.int32)))
        low = 0
        for width in (2, 4, 6, 8, 10, 12, 16, 24, SHORT):
            rows = np.flatnonzero((sizes > low) & (sizes <= width) & ~stands)
            low = width
            for some in np.array_split(rows, len(rows) // 100_000 + 1):
                places = offsets[some][:, None] + np.arange(width)[None, :]
                inside = np.arange(width)[None, :] < sizes[some][:, None]
                ids = np.where(inside, self._inner[data[np.minimum(places, len(data) - 1)]], np.int32(-1))
                ids[np.arange(len(some)), sizes[some] - 1] = self._last[data[offsets[some] + sizes[some] - 1]]
                found.append((some, self._merge_short(ids)))
        for row in np.flatnonzero(sizes > SHORT).tolist():
            ids = self._merge_long(data[offsets[row] : offsets[row + 1]].tobytes())
            found.append((np.array([row]), np.array([ids], np.int32)))
        for rows, ids in found:
            counts[rows] = (ids >= 0).sum(1)
        starts = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.int32)
        for rows, ids in found:
            valid = ids >= 0
            flat[(starts[rows][:, None] + np.arange(ids.shape[1])[None, :])[valid]] = ids[valid]
        return counts, flat

    def _pieces(self, words: list[str]) -> tuple[np.ndarray, pa.DictionaryArray]:
        """Pieces of all words by the pattern: the word of each, and the pieces as bytes."""
        joined = "\n".join(words)
        for k, token in enumerate(self.special):
            joined = joined.replace(token, chr(FIRST_SPECIAL + k))
        # Lower case letter by letter: a final sigma is not told from another one.
        joined = unicodedata.normalize("NFC", joined).replace("Σ", "σ").lower()
        points = points_of(joined)
        kinds = classes()[points]
        size = len(points)
        begins = np.ones(size, bool)
        begins[1:] = kinds[1:] != kinds[:-1]
        begins |= (kinds == NUMBER) | (kinds == SPECIAL)
        begins &= kinds != 0
        # An apostrophe alone in its run takes one of the endings with it.
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        marks = np.flatnonzero((points == ord("'")) & begins)
        marks = marks[np.concatenate([kinds, [0]])[marks + 1] == LETTER]
        for ending in ENDINGS:
            fits = marks
            for k, letter in enumerate(ending):
                fits = fits[padded[fits + 1 + k] == ord(letter)]
            begins[fits + 1] = False
            rest = fits + 1 + len(ending)
            rest = rest[rest < size]
            begins[rest[kinds[rest] == LETTER]] = True
        starts = np.flatnonzero(begins)
        owner = np.searchsorted(np.flatnonzero(points == ord("\n")), starts)
        keep = kinds != 0
        kept = points[keep]
        data = kept.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        width = 1 + (kept >= 0x80).astype(np.int32) + (kept >= 0x800) + (kept >= 0x10000)
        ends = np.concatenate([[0], np.cumsum(width)])
        at = np.concatenate([(np.cumsum(keep) - 1)[starts], [len(kept)]])
        offsets = ends[at].astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return owner, pieces.dictionary_encode()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin and end. Nulls have none."""
        split = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        words = coded.dictionary.to_pylist()
        owner, pieces = self._pieces(words)
        counts, ids = self._encode_words(pieces.dictionary)
        kinds = pieces.indices.to_numpy()
        per_word = np.bincount(owner, counts[kinds], len(words)).astype(np.int64)
        ids = _ragged(np.cumsum(counts) - counts, counts, ids, kinds)
        flat = _ragged(np.cumsum(per_word) - per_word, per_word, ids, codes)
        ends = np.concatenate([[0], np.cumsum(per_word[codes])])
        lists = split.offsets.to_numpy()
        return flat, ends[lists - lists[0]]

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of an array that fits a segment, or of one longer text."""
        if len(texts) == 1 and texts[0].is_valid and pc.binary_length(texts)[0].as_py() > SEGMENT:
            parts = [self.encode(pa.array([part], pa.string()))[0] for part in segments(texts[0].as_py(), SEGMENT // 2)]
            yield np.concatenate(parts)
            return
        flat, ends = self.encode(texts)
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            yield flat[a:b]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids, joined by a blank: what a vocabulary without a decoder gives."""
        return " ".join([self.tokens[i] for i in ids])

    def joined(self, ids: np.ndarray, decoded: bool) -> Iterator[bytes]:
        """The decoded text, or the decimal ids joined by a blank, as bytes in bounded pieces."""
        table = self._strings if decoded else self._numbers
        for start in range(0, len(ids), 1 << 20):
            some = table.take(pa.array(ids[start : start + (1 << 20)], pa.int32()))
            one = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), " ")[0]
            yield (b" " if start else b"") + one.as_buffer().to_pybytes()


def segments(text: str, size: int) -> Iterator[str]:
    """A text in parts of about ``size`` that end before white space; a word is never cut."""
    start = 0
    while start < len(text):
        found = _BLANK.search(text, start + size)
        stop = found.start() if found else len(text)
        yield text[start:stop]
        start = stop


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, read once per Python worker."""
    return Encoder(path)


Row = Callable[[Encoder, np.ndarray], tuple]


def map_ids(docs: DataFrame, path: str, row: Row, names: list[str], types: list[str]) -> DataFrame:
    """doc_id and what ``row`` makes of each text's ids, in one pass of the scan."""
    arrow = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in slices(batches, "text", SEGMENT):
            out = [row(own, ids) for ids in own.encode_all(part.column("text"))]
            arrays = [pa.array(x, arrow[t]) for x, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], ["doc_id", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} {t}" for n, t in zip(names, types)))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    return map_ids(docs, path, lambda own, ids: (ids,), ["ids"], ["array<int>"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows that ``encode`` made; null ids give a null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = [own.decode(x.as_py()) if x.is_valid else None for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
