"""Quality classification by regularised quadratic discriminant analysis of document statistics.

Every whole text is described by ``FEATURES``: logs of mean sizes, and shares brought to an even scale by the arc sine of their
root. Each starts from ``PSEUDO`` units of ordinary text, so that a text of a few words is not judged by one of them. Each class has a mean and a covariance, shrunk towards the pooled one (``TO_POOLED``) and from there towards its
diagonal (``TO_DIAGONAL``), so few labels or constant features leave it regular. The score is the logistic value of the difference of
log densities, which are Mahalanobis distances from cached Cholesky factors, plus the log odds of the classes.

Learning uses all labelled rows it is given: counts, sums and sums of products per class, aggregated in Spark, are all
that reaches the driver. With one class only, or none, every score is the share of label 1, or 0.5.

Null texts count as empty and are scored as such. Labels that disagree on a document go by their mean, 1 from a half on;
null labels teach nothing. Texts of any length are counted in segments but for their distinct words and lines, which are
held. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import materialize, slices

FEATURES = (
    "word_size", "long_words", "short_words", "distinct_words", "distinct_lines", "line_words",
    "upper", "digits", "stops", "symbols", "beyond_ascii", "capital_words", "marked_words",
)
# Words, or fives of characters, that a text's shares start from, and the shares of ordinary text.
PSEUDO = 20
ORDINARY = {"long": 0.01, "short": 0.35, "upper": 0.03, "digit": 0.002, "stop": 0.04, "symbol": 0.002, "beyond": 0.04, "capital": 0.1, "marked": 0.01}
TO_POOLED = 0.2
TO_DIAGONAL = 0.1
THRESHOLD = 0.3
_LIMIT = 6.0  # standard deviations, beyond which a feature tells no more

# Kinds of bytes.
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _SYMBOL, _BEYOND = range(7)


def _kinds() -> np.ndarray:
    out = np.full(256, _SYMBOL, np.uint8)
    out[128:] = _BEYOND
    for kind, letters in ((_LOWER, b"abcdefghijklmnopqrstuvwxyz"), (_UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (_DIGIT, b"0123456789"), (_SPACE, b" \t\n\x0b\x0c\r"), (_STOP, b".,;:'\"-()?")):
        out[list(letters)] = kind
    return out


_KINDS = _kinds()


def _root(part: float, whole: float, ordinary: float, pseudo: float = PSEUDO) -> float:
    """A share on an even scale."""
    return float(np.arcsin(np.sqrt(min(1.0, (part + ordinary * pseudo) / (whole + pseudo)))))


def describe(text: str | None) -> list[float]:
    """The features of one text."""
    data = (text or "").encode()
    values = np.frombuffer(data, np.uint8)
    counts = sum((np.bincount(_KINDS[values[at : at + (1 << 22)]], minlength=7) for at in range(0, len(values), 1 << 22)), np.zeros(7, np.int64))
    words, lines = data.split(), data.split(b"\n")
    n, letters = len(words), counts[_LOWER] + counts[_UPPER] + counts[_BEYOND]
    sizes = np.fromiter(map(len, words), np.int64, n)
    capital = sum(w[:1].isupper() for w in words)
    marked = sum(not (w[-1:].isalnum() or w[-1] > 127 or w[-1:] in b".,") for w in words)
    total, usual = len(data) - counts[_SPACE], ORDINARY
    return [
        np.log((int(sizes.sum()) + 5 * PSEUDO) / (n + PSEUDO)),
        _root(int((sizes > 15).sum()), n, usual["long"]),
        _root(int((sizes < 4).sum()), n, usual["short"]),
        np.log(len(set(words)) + PSEUDO) / np.log(n + PSEUDO),
        _root(len(set(lines)), len(lines), 1.0, 5),
        np.log((n + PSEUDO) / (len(lines) + 1)),
        _root(counts[_UPPER], letters, usual["upper"], 5 * PSEUDO),
        _root(counts[_DIGIT], total, usual["digit"], 5 * PSEUDO),
        _root(counts[_STOP], total, usual["stop"], 5 * PSEUDO),
        _root(counts[_SYMBOL], total, usual["symbol"], 5 * PSEUDO),
        _root(counts[_BEYOND], total, usual["beyond"], 5 * PSEUDO),
        _root(capital, n, usual["capital"]),
        _root(marked, n, usual["marked"]),
    ]


def features(docs: DataFrame, keep: list[str | Column]) -> DataFrame:
    """The ``keep`` columns of every row with one double per feature, in one pass of the scan."""
    rows = docs.select(*keep, F.col("text").alias("_text"))
    kept = [x for x in rows.columns if x != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", 1 << 23):
            table = np.array([describe(x.as_py()) for x in part.column("_text")]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*[part.column(x) for x in kept], *[pa.array(c) for c in table.T]], [*kept, *FEATURES])

    fields = ", ".join([f"`{x}` {t}" for x, t in rows.dtypes if x != "_text"] + [f"{x} double" for x in FEATURES])
    return rows.mapInArrow(run, fields)


@dataclass(frozen=True)
class Model:
    share: float  # of label 1
    centre: np.ndarray  # for scaling
    spread: np.ndarray
    means: np.ndarray | None  # class x feature
    factors: np.ndarray | None  # class x feature x feature: inverted Cholesky factors
    log_dets: np.ndarray | None

    def score(self, table: np.ndarray) -> np.ndarray:
        """Posterior of label 1 of each row of features."""
        if self.means is None:
            return np.full(len(table), self.share)
        scaled = np.clip((table - self.centre) / self.spread, -_LIMIT, _LIMIT)
        density = [-0.5 * (((scaled - self.means[k]) @ self.factors[k].T) ** 2).sum(1) - 0.5 * self.log_dets[k] for k in (0, 1)]
        odds = density[1] - density[0] + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def learn(described: DataFrame, label: str = "label") -> Model:
    """Fit on rows with features and a 0 or 1 label."""
    size = len(FEATURES)
    rows = described.filter(F.col(label).isin(0, 1))
    ends = rows.agg(F.count("*").alias("n"), *[F.avg(x).alias(f"m_{x}") for x in FEATURES], *[F.stddev_pop(x).alias(f"s_{x}") for x in FEATURES]).first()
    if not ends["n"]:
        return Model(0.5, np.zeros(size), np.ones(size), None, None, None)
    centre = np.array([ends[f"m_{x}"] for x in FEATURES])
    spread = np.maximum([ends[f"s_{x}"] for x in FEATURES], 1e-6)
    scaled = [
        F.greatest(F.lit(-_LIMIT), F.least(F.lit(_LIMIT), (F.col(x) - F.lit(float(c))) / F.lit(float(s)))).alias(x)
        for x, c, s in zip(FEATURES, centre, spread)
    ]
    products = [F.sum(F.col(a) * F.col(b)).alias(f"p_{i}_{j}") for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES) if i <= j]
    sums = [F.sum(a).alias(f"t_{i}") for i, a in enumerate(FEATURES)]
    found = rows.select(F.col(label).cast("int").alias("label"), *scaled).groupBy("label").agg(F.count("*").alias("n"), *sums, *products).collect()
    by = {row["label"]: row for row in found}
    share = by[1]["n"] / ends["n"] if 1 in by else 0.0
    if len(by) < 2:
        return Model(share, centre, spread, None, None, None)
    means, covariances = [], []
    for k in (0, 1):
        mean = np.array([by[k][f"t_{i}"] for i in range(size)]) / by[k]["n"]
        square = np.array([[by[k][f"p_{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)]) / by[k]["n"]
        means.append(mean)
        covariances.append(square - np.outer(mean, mean))
    pooled = (1 - share) * covariances[0] + share * covariances[1]
    factors, log_dets = [], []
    for own in covariances:
        shrunk = (1 - TO_POOLED) * own + TO_POOLED * pooled
        shrunk = (1 - TO_DIAGONAL) * shrunk + TO_DIAGONAL * np.diag(np.diag(shrunk)) + 1e-3 * np.eye(size)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * np.log(np.diag(lower)).sum())
    return Model(share, centre, spread, np.array(means), np.array(factors), np.array(log_dets))


def accept(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows that score ``threshold`` or more, described and judged in one pass of the scan. A model of one class rejects nothing."""
    if model.means is None:
        return docs
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 23):
            table = np.array([describe(x.as_py()) for x in part.column("text")]).reshape(-1, len(FEATURES))
            yield part.filter(pa.array(model.score(table) >= threshold))

    return docs.mapInArrow(run, schema)


def with_labels(described: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of labelled documents with their label."""
    known = labels.select("doc_id", F.col("quality").cast("double").alias("quality")).dropna()
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    return described.join(known, "doc_id")


def predict(described: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows with score and predicted in place of the features."""
    kept = [x for x in described.columns if x not in FEATURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(np.stack([batch.column(x).to_numpy() for x in FEATURES], 1))
            arrays = [*[batch.column(x) for x in kept], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "score", "predicted"])

    fields = ", ".join(f"`{x}` {t}" for x, t in described.dtypes if x in kept)
    return described.mapInArrow(run, f"{fields}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; labels of rows that are held out are not learned."""
    described = features(docs, [F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out")])
    described = materialize(described, "statistics")
    model = learn(with_labels(described.filter(~F.col("held_out")), labels))
    return predict(described, model, threshold)
