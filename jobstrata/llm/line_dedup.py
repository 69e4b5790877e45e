"""Line deduplication over a log-template tree of fixed depth.

A line becomes tokens at white space; a token with a digit is a variable field. The tree leads from the number of tokens
over the first ``LEADING`` tokens to a leaf. Within a leaf, a line stands for the template of its own tokens and, from
``GENERAL`` tokens on, for ``SPANS`` more in which one of as many equal spans of the other positions is a variable field as
well. Fields are no evidence of a repeat: a template needs ``CONSTANT`` constant tokens, one with a free span ``EVIDENCE``,
and in both at least half of the tokens must be constant. A line with too few, such as a row of numbers, stands for
itself, digits included. Two lines thus share a template if they agree but for digits and one span, and no line is compared with
another: templates are counted by key, with partial results per task, however many lines a leaf has.

A template that documents share recurs. It stays in the first document that has it, by ``doc_id``, and its lines are
dropped from all later ones; what they had in the variable fields, digits and the free span, goes with them. Lines of fewer than ``SHORTEST`` words are no
templates and stay. Repeats inside one document are not touched.

Lines that share a long run of words but differ otherwise are no template together. ``clean``, and so the pipeline, takes
such passages out as well, from what the templates leave: of the windows of ``WINDOW`` words of a document, line ends
counting as blanks, it keys the ones of least hash among ``WINDOW`` neighbours. Content alone chooses them, so an insertion
shifts none, and every run of ``2 * WINDOW - 1`` words or more has one. A keyed window stays in the first document that
has it; its words go from all later ones, of a long run all but at most ``WINDOW - 1`` at either end. ``deduplicate``
has the templates alone, as its SQL.

Documents are never dropped; one whose lines all recur has an empty text. Null texts stay null. Rows without a doc_id are
left as they are and do not count. Rows that share a doc_id count as one document. Texts of any length are handled line by
line, an endless line is one line. Extra columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import aside, materialize, release, slices

LEADING = 2
SPANS = 4
GENERAL = 8
SHORTEST = 5
CONSTANT = 4
EVIDENCE = 8
WINDOW = 25
_DIGIT = re.compile(rb"[0-9]")
_SEED = 42
_WORD = re.compile(rb"\S+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def line_keys(line: bytes) -> list[int]:
    """Hashes of the templates that a line stands for, its own first; none for a line that is too short."""
    tokens = line.split()
    n = len(tokens)
    if n < SHORTEST:
        return []
    fixed = [1] * n
    if _DIGIT.search(line):
        fixed = [0 if _DIGIT.search(x) else 1 for x in tokens]
        if _evident(sum(fixed), n, CONSTANT):
            tokens = [x if own else b"<*>" for x, own in zip(tokens, fixed)]
    starts = [(n - LEADING) * k // SPANS + LEADING for k in range(SPANS + 1)]
    spans = [b" ".join(tokens[a:b]) for a, b in zip(starts, starts[1:])]
    # No token holds a line feed, so it keeps the parts apart.
    node = b"%d\n%b\n" % (n, b" ".join(tokens[:LEADING]))
    texts = [node + b"-1\n" + b"\n".join(spans)]
    if n >= GENERAL:
        for k, (a, b) in enumerate(zip(starts, starts[1:])):
            if _evident(sum(fixed) - sum(fixed[a:b]), n - (b - a), EVIDENCE):
                texts.append(node + b"%d\n%b" % (k, b"\n".join(spans[:k] + spans[k + 1 :])))
    return [xxhash.xxh64_intdigest(x, _SEED) for x in texts]


def _evident(constant: int, tokens: int, least: int) -> bool:
    return constant >= least and 2 * constant >= tokens


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, line (its hash) and keys, one row per line that stands for a template."""
    for part in slices(batches, "text", 1 << 22):
        docs, lines, keys, ends = [], [], [], [0]
        for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
            for line in text.as_py().encode().split(b"\n"):
                if found := line_keys(line):
                    docs.append(doc)
                    lines.append(xxhash.xxh64_intdigest(line, _SEED))
                    keys += found
                    ends.append(len(keys))
        whole = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _longs(keys))
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), _longs(lines), whole], ["doc_id", "line", "keys"])


def _longs(hashes: list[int]) -> pa.Array:
    return pa.array(np.array(hashes, np.uint64).view(np.int64))


def template_keys(docs: DataFrame) -> DataFrame:
    """doc_id, line (its hash) and key, one row per line and template it stands for.

    Lines are cut into templates once and written; both uses of the keys read what was written.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").dropna()
    lines = materialize(rows.mapInArrow(_lines, "doc_id long, line long, keys array<long>"), "templates")
    release(docs.sparkSession)
    return lines.select("doc_id", "line", F.explode("keys").alias("key"))


def _met(keyed: DataFrame) -> DataFrame:
    """The rows whose key an earlier document has."""
    # A key of its own for the join (see operators.joins): the rows of a hot key stay splittable.
    first = keyed.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    first = first.withColumn("salt", F.xxhash64("key")).select("key", "salt", "first")
    return keyed.withColumn("salt", F.xxhash64("key")).join(first, ["key", "salt"]).filter("doc_id > first")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id and the array ``_gone`` of hashes of its lines whose template an earlier document has."""
    met = _met(template_keys(docs))
    return met.select("doc_id", "line").distinct().groupBy("doc_id").agg(F.collect_list("line").alias("_gone"))


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text without the lines in ``_gone``, and counts of lines."""
    for batch in batches:
        texts, sizes, dropped = [], [], []
        for text, gone in zip(batch.column("text"), batch.column("_gone")):
            whole = text.as_py()
            if whole is None or not gone.is_valid:
                texts.append(whole)
                sizes.append(0 if whole is None else whole.count("\n") + 1)
                dropped.append(0)
                continue
            lines, out = whole.split("\n"), set(gone.as_py())
            kept = [x for x in lines if _signed(xxhash.xxh64_intdigest(x.encode(), _SEED)) not in out]
            texts.append("\n".join(kept))
            sizes.append(len(lines))
            dropped.append(len(lines) - len(kept))
        others = [x for x in batch.schema.names if x not in ("text", "_gone")]
        arrays = [*[batch.column(x) for x in others], pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, [*others, "text", "_n_lines", "_n_dropped"])


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _stripped(docs: DataFrame, keep: list[str]) -> DataFrame:
    others = [x for x in keep if x not in ("text", "doc_id")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *others, "text")
    marked = rows.join(repeated_lines(docs), "doc_id", "left")
    fields = ", ".join(f"`{x}` {t}" for x, t in marked.dtypes if x not in ("text", "_gone"))
    return marked.mapInArrow(_strip, f"{fields}, text string, _n_lines long, _n_dropped long")


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, remaining text, n_lines (before) and n_dropped of every row."""
    return _stripped(docs, []).withColumnsRenamed({"_n_lines": "n_lines", "_n_dropped": "n_dropped"})


def windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the keyed windows; none for fewer words than the shortest run that surely has one."""
    size = len(words) - WINDOW + 1
    if size < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes, out = np.array([xxhash.xxh64_intdigest(x, _SEED) for x in words], np.uint64), np.zeros(size, np.uint64)
    for k in range(WINDOW):
        out = (out + hashes[k : k + size]) * _STEP
        out ^= out >> np.uint64(29)
    least = np.lib.stride_tricks.sliding_window_view(out, WINDOW).argmin(1)
    starts = np.unique(least + np.arange(len(least)))
    return starts, out[starts]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and key, one row per distinct keyed window of a row."""
    for part in slices(batches, "text", 1 << 22):
        docs, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
            keys.append(np.unique(windows(text.as_py().encode().split())[1]))
            docs.append(np.full(len(keys[-1]), doc, np.int64))
        arrays = [pa.array(np.concatenate(docs)), pa.array(np.concatenate(keys).view(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "key"])


def without_windows(text: str, gone: set[int]) -> str:
    """Text without the words of the keyed windows in ``gone``; a line end stays where lines were cut."""
    raw = text.encode()
    places = [x.span() for x in _WORD.finditer(raw)]
    starts, keys = windows([raw[a:b] for a, b in places])
    cut = np.zeros(len(places) + 2, np.int8)
    for start, key in zip(starts.tolist(), keys.view(np.int64).tolist()):
        if key in gone:
            cut[start + 1 : start + 1 + WINDOW] = 1
    edges = np.flatnonzero(np.diff(cut)).tolist()
    out, at = [], 0
    for first, after in zip(edges[::2], edges[1::2]):
        stop = places[after][0] if after < len(places) else places[-1][1]
        out += [raw[at : places[first][0]], b"\n" if b"\n" in raw[places[first][0] : stop] else b""]
        at = stop
    return b"".join([*out, raw[at:]]).decode()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in zip(batch.column("text"), batch.column("_gone")):
            texts.append(without_windows(text.as_py(), set(gone.as_py())) if text.is_valid and gone.is_valid else text.as_py())
        others = [x for x in batch.schema.names if x not in ("text", "_gone")]
        yield pa.RecordBatch.from_arrays([*[batch.column(x) for x in others], pa.array(texts, pa.string())], [*others, "text"])


def without_passages(docs: DataFrame) -> DataFrame:
    """Every row with its columns, ``doc_id`` as a long; its text lacks the keyed windows that an earlier document has."""
    rows = docs.select("doc_id", "text").dropna()
    keyed = materialize(rows.mapInArrow(_windows, "doc_id long, key long"), "windows")
    release(docs.sparkSession)
    met = _met(keyed).select("doc_id", "key").distinct().groupBy("doc_id").agg(F.collect_list("key").alias("_gone"))
    marked = docs.join(met, "doc_id", "left")
    fields = ", ".join(f"`{x}` {t}" for x, t in marked.dtypes if x not in ("text", "_gone"))
    return marked.mapInArrow(_cut, f"{fields}, text string")


def clean(docs: DataFrame) -> DataFrame:
    """Every row with all its columns and the text without repeated lines and passages; n_chars, if there is one, is counted anew."""
    columns = docs.columns
    docs, back = aside(docs, ("_gone", "_n_lines", "_n_dropped"))
    found = without_passages(materialize(_stripped(docs, docs.columns).drop("_n_lines", "_n_dropped"), "stripped"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return found.withColumnsRenamed(back).select(*columns)
