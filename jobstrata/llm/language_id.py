"""Language identification, word first with back-off to character n-grams.

Each known word of a text adds its smoothed log frequency per language. A word that no language's list has falls back to
its known n-grams of four characters (word ends count as one), if there are none to those of three, two and one. The
language with the greatest sum, prior included, is predicted. The score is its posterior share, with the evidence of long
texts scaled down to ``EVIDENCE`` words so that it says something about them too.

Learning takes a sample of the labelled rows: about ``PER_LANGUAGE`` of each language, chosen by a hash of text and id,
all if there are fewer; every language that occurs is learned. Counts over the sample run in Spark, and at most ``WORDS`` + 4 x
``GRAMS`` of each language reach the driver and the workers; beyond ``LANGUAGES`` languages fewer of each, so that the table of
items by languages keeps its size. Prediction reads every whole text in one pass.

Null texts and texts without a letter are ``und`` with score 0; so is everything if nothing could be learned. Rows without
lang teach nothing. Texts of any length are read in segments. Repeated rows get equal results; a tie goes to the first language by
name. An empty table teaches nothing and gives an empty result. Columns named like the result's are kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.llm.bpe import SEGMENT, segments
from jobstrata.llm.chars import LETTER, classes, points_of
from jobstrata.llm.common import aside, slices

PER_LANGUAGE = 3000
LANGUAGES = 64
WORDS = 20_000
GRAMS = 5_000
ORDERS = (4, 3, 2, 1)
EVIDENCE = 30
UNKNOWN = "und"
_SMOOTH = 0.5
_BLANK = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    prior: np.ndarray  # log share of each language
    words: list[str]
    word_scores: np.ndarray  # word x language
    gram_keys: dict[int, np.ndarray]  # per order: sorted keys
    gram_scores: dict[int, np.ndarray]  # per order: key x language


def _keys(points: np.ndarray, order: int) -> np.ndarray:
    """One number for the ``order`` code points from each place on."""
    size = len(points) - order + 1
    out = np.zeros(max(size, 0), np.uint64)
    for k in range(order):
        out = (out + points[k : k + len(out)].astype(np.uint64)) * _STEP
        out ^= out >> np.uint64(29)
    return out


# Learning.


def _sample(labelled: DataFrame, per_language: int) -> tuple[DataFrame, dict[str, int]]:
    """About ``per_language`` rows of each language, and how many each language has."""
    sizes = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().orderBy("lang").collect()}
    if not sizes:
        return labelled.limit(0), sizes
    rate = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))])
    draw = F.pmod(F.xxhash64("text", "drawn_by"), F.lit(1 << 20)) / (1 << 20)
    return labelled.filter(draw < rate[F.col("lang")]), sizes


def _most(counts: DataFrame, group: list[str], item: str, limit: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("n"), item))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= limit).drop("rank")


def _scores(rows: list, column: str, languages: list[str]) -> tuple[list[str], np.ndarray]:
    """Distinct items and their smoothed log frequency per language."""
    items = sorted({row[column] for row in rows})
    place, lang = {x: i for i, x in enumerate(items)}, {x: i for i, x in enumerate(languages)}
    counts = np.full((len(items), len(languages)), _SMOOTH)
    for row in rows:
        counts[place[row[column]], lang[row["lang"]]] += row["n"]
    return items, np.log(counts / counts.sum(0)).astype(np.float32)


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Learn from rows with text and lang, every language that occurs."""
    # Copies of one text are drawn one by one, if rows have ids.
    drawn_by = F.col("doc_id").cast("string") if "doc_id" in labelled.columns else F.lit("")
    rows = labelled.select("lang", "text", F.coalesce(drawn_by, F.lit("")).alias("drawn_by")).dropna()
    sample, sizes = _sample(rows, per_language)
    languages = sorted(sizes)
    # Scores are a table of items by languages; with very many languages each brings fewer items.
    share = min(1.0, (LANGUAGES / max(1, len(languages))) ** 2)
    words, grams = max(200, int(words * share)), max(100, int(grams * share))
    prior = np.log(np.array([sizes[x] for x in languages], float) / max(1, sum(sizes.values())))
    each = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    counts = each.groupBy("lang", "word").agg(F.count("*").alias("n")).persist()
    known = _most(counts, ["lang"], "word", words).collect()
    marked = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    parts = F.explode(
        F.flatten(
            F.array(
                *[
                    F.transform(
                        F.when(F.length(marked) >= k, F.sequence(F.lit(1), F.length(marked) - (k - 1))).otherwise(F.array().cast("array<int>")),
                        lambda i, k=k: F.substring(marked, i, F.lit(k)),
                    )
                    for k in ORDERS
                ]
            )
        )
    )
    pieces = counts.select("lang", "n", parts.alias("gram")).filter(F.trim("gram") != "")
    pieces = pieces.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("order", F.length("gram"))
    found = _most(pieces, ["lang", "order"], "gram", grams).collect()
    counts.unpersist()
    items, word_scores = _scores(known, "word", languages)
    keys, scores = {}, {}
    for order in ORDERS:
        names, table = _scores([row for row in found if row["order"] == order], "gram", languages)
        numbers = np.array([_keys(points_of(x), order)[0] for x in names if len(x) == order], np.uint64)
        table = table[[i for i, x in enumerate(names) if len(x) == order]]
        by = np.argsort(numbers)
        keys[order], scores[order] = numbers[by], table[by]
    return Model(languages, prior, items, word_scores, keys, scores)


# Prediction.


class _Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.words = pa.array(model.words, pa.string())

    def _back_off(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mean score of the known n-grams of each word, of the greatest order that has any."""
        out = np.zeros((len(starts), len(self.model.languages)), np.float32)
        todo = np.arange(len(starts))
        for order in ORDERS:
            keys, table = self.model.gram_keys[order], self.model.gram_scores[order]
            sizes = np.maximum(ends[todo] - starts[todo] + 2 - (order - 1), 0)
            if not len(keys) or not sizes.sum():
                continue
            owner = np.repeat(np.arange(len(todo)), sizes)
            first = np.repeat(starts[todo] - 1 - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            numbers = _keys(points, order)[first]
            at = np.minimum(np.searchsorted(keys, numbers), len(keys) - 1)
            hit = keys[at] == numbers
            owner, at = owner[hit], at[hit]
            found = np.bincount(owner, minlength=len(todo))
            some = found > 0
            for k in range(out.shape[1]):
                sums = np.bincount(owner, table[at, k], len(todo))
                out[todo[some], k] = (sums[some] / found[some]).astype(np.float32)
            todo = todo[~some]
        return out

    def _tokens(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of word scores, and number of words, of each distinct run of non-blanks."""
        joined = "\n" + "\n".join(tokens).lower() + "\n"
        points = points_of(joined).copy()
        letter = classes()[points] == LETTER
        lines = np.flatnonzero(points == 10)
        points[~letter] = _BLANK
        change = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        starts, ends = change[::2], change[1::2]
        owner = np.searchsorted(lines, starts) - 1
        flat = points[letter].tobytes().decode("utf-32-le")
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).tolist()
        words = pa.array([flat[a:b] for a, b in zip(offsets, offsets[1:])], pa.string()).dictionary_encode()
        codes = words.indices.to_numpy()
        place = pc.index_in(words.dictionary, value_set=self.words).fill_null(-1).to_numpy()
        vectors = np.zeros((len(place), len(self.model.languages)), np.float32)
        vectors[place >= 0] = self.model.word_scores[place[place >= 0]]
        once = np.empty(len(place), np.int64)
        once[codes] = np.arange(len(codes))  # some occurrence of each distinct word
        unseen = np.flatnonzero(place < 0)
        vectors[unseen] = self._back_off(points, starts[once[unseen]], ends[once[unseen]])
        sums = np.stack([np.bincount(owner, vectors[codes, k], len(tokens)) for k in range(vectors.shape[1])], 1)
        return sums, np.bincount(owner, minlength=len(tokens))

    def sums(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Summed scores and number of words of each text."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        scores, counts = self._tokens(coded.dictionary.to_pylist())
        lists = split.offsets.to_numpy()
        doc = np.repeat(np.arange(len(texts)), np.diff(lists))
        sums = [np.bincount(doc, scores[codes, k], len(texts)) for k in range(scores.shape[1])]
        return np.stack(sums, 1), np.bincount(doc, counts[codes], len(texts))

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        if len(texts) == 1 and texts[0].is_valid and pc.binary_length(texts)[0].as_py() > SEGMENT:
            parts = [self.sums(pa.array([x], pa.string())) for x in segments(texts[0].as_py(), SEGMENT // 2)]
            sums, words = sum(x for x, _ in parts), sum(n for _, n in parts)
        else:
            sums, words = self.sums(texts)
        total = sums + self.model.prior
        scaled = total * np.minimum(1.0, EVIDENCE / np.maximum(words, 1))[:, None]
        share = np.exp(scaled - scaled.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        best = total.argmax(1)
        has = words > 0
        names = [self.model.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), has.tolist())]
        return names, np.where(has, share[np.arange(len(best)), best], 0.0).tolist()


def predict(docs: DataFrame, model: Model, keep: list[str | Column]) -> DataFrame:
    """The ``keep`` columns of every row with lang_pred and score, in one pass of the scan."""
    rows = docs.select(*keep)
    text = "text" if "text" in rows.columns else "_text"
    rows = rows if text == "text" else docs.select(*keep, F.col("text").alias(text))
    kept = [x for x in rows.columns if x != "_text"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for part in slices(batches, text, SEGMENT):
            if shared.value.languages and part.num_rows:
                names, scores = scorer.predict(part.column(text))
            else:
                names, scores = [UNKNOWN] * part.num_rows, [0.0] * part.num_rows
            arrays = [*[part.column(x) for x in kept], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "lang_pred", "score"])

    fields = ", ".join(f"`{x}` {t}" for x, t in rows.dtypes if x != "_text")
    return rows.mapInArrow(run, f"{fields}, lang_pred string, score double")


def accept(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows whose language is known with a score of ``least`` or more. A model that has learned nothing rejects nothing."""
    if not model.languages:
        return docs
    rows, back = aside(docs, ("lang_pred", "score"))
    found = predict(rows, model, ["*"]).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.drop("lang_pred", "score").withColumnsRenamed(back).select(*docs.columns)
