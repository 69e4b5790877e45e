"""URL filters: fixed rules first, gradient-boosted trees on lexical features for the rest. DataFrame functions only.

The host is what stands behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, the path goes on from there up to
``?``, ``#`` or the end. A rule fits its host and all subdomains if the path starts with the rule's; the longest rule wins.

URLs that a rule decides are the labelled ones. Their lexical features and the share of blocked ones per suffix (the last
part of the host, smoothed) train ``TREES`` trees of depth ``DEPTH`` on the logistic loss, both verdicts weighing the same,
as the rules say nothing about how frequent either is elsewhere. Training takes about ``SAMPLE``
labelled URLs, chosen by a hash, all if there are fewer. Features are cut at ``BINS`` quantiles of either verdict and the extremes, those of few values at each value; each level of a tree
is one aggregate of gradients per node, feature and bin over the sample, and only those sums reach the driver. The trees
become a CASE expression that runs inside the scan of all URLs.

A null URL and one without ``://`` have an empty host and path and are judged by the trees as the empty string. Without
labelled URLs of both verdicts every other URL gets the only verdict known, or ``allow``. Repeated rows get equal results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import materialize
from jobstrata.operators.joins import attach_lookup

SAMPLE = 20_000
TREES = 8
DEPTH = 3
BINS = 16
RATE = 0.4
RIDGE = 1.0
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits", "hyphens", "entropy",
    "params", "fragment", "secure", "suffix_blocked",
)


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and the path that a URL's path must start with."""

    verdict: str
    text: str

    @property
    def parts(self) -> tuple[str, str]:
        host, slash, path = self.text.partition("/")
        return host, slash + path


def parse(pages: DataFrame) -> DataFrame:
    """Adds host and path."""
    url = F.coalesce("url", F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return pages.withColumns({"host": F.translate(host, _UPPER, _UPPER.lower()), "path": path})


def with_rule(parsed: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds rule and ruled (its verdict), null where no rule fits."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The longest is asked first, so it is the outermost condition.
    for rule in sorted(rules, key=lambda r: len(r.text)):
        host, path = rule.parts
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return parsed.withColumns({"rule": found, "ruled": verdict})


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    counts = F.transform(F.array_distinct(F.split(text, "")), lambda c: size - F.length(F.replace(text, c, F.lit(""))))
    bits = F.aggregate(counts, F.lit(0.0), lambda total, n: total - F.when(n > 0, n / size * F.log2(n / size)).otherwise(0.0))
    return F.when(size > 0, bits).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical(ruled: DataFrame) -> DataFrame:
    """Adds the lexical features and the suffix."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return ruled.withColumns(
        {
            "length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": _count(path, "/[^/]"),
            "labels": _count(host, r"[^.]+"),
            "digit_ratio": _count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)),
            "host_digits": _count(host, "[0-9]"),
            "hyphens": _count(host, "-"),
            "entropy": _entropy(url),
            "params": _count(query, "[^&]+"),
            "fragment": F.contains(url, F.lit("#")).cast("double"),
            "secure": F.startswith(F.lower(url), F.lit("https:")).cast("double"),
            "suffix": F.substring_index("host", ".", -1),
        }
    )


def with_suffix_statistics(rows: DataFrame, blocked: int, allowed: int, weight: float = 0.01) -> DataFrame:
    """Adds the blocked share of the labelled URLs per suffix, with both verdicts weighing the same.

    A suffix without labelled URLs has a share of one half.
    """
    known = rows.filter(F.col("ruled").isNotNull()).groupBy("suffix")
    known = known.agg(F.count("*").alias("_n"), F.count(F.when(F.col("ruled") == "block", 1)).alias("_blocked"))
    out = attach_lookup(rows, known, ["suffix"], ["_n", "_blocked"])
    n, stopped = F.coalesce("_n", F.lit(0)), F.coalesce("_blocked", F.lit(0))
    bad, good = stopped / max(1, blocked) + weight, (n - stopped) / max(1, allowed) + weight
    return out.withColumn("suffix_blocked", bad / (bad + good)).drop("_n", "_blocked")


@dataclass
class Trees:
    base: float = 0.0
    trees: list = field(default_factory=list)

    def margin(self) -> Column:
        """Log odds of block as an expression over the features."""
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + _expression(tree, lambda leaf: F.lit(leaf))
        return total


def _expression(tree, leaf) -> Column:
    """A tree is a leaf value or (feature, threshold, left, right); rows up to the threshold go left."""
    if not isinstance(tree, tuple):
        return leaf(tree)
    name, threshold, left, right = tree
    return F.when(F.col(name) <= F.lit(threshold), _expression(left, leaf)).otherwise(_expression(right, leaf))


def _best(sums: dict, edges: dict[str, list[float]]) -> tuple | None:
    """The split of one node with the greatest gain, from its sums of gradient and curvature per feature and bin."""
    best, gain = None, 1e-6
    for name in FEATURES:
        bins = sums.get(name, {})
        g, h = sum(x[0] for x in bins.values()), sum(x[1] for x in bins.values())
        left_g = left_h = 0.0
        for k, edge in enumerate(edges[name]):
            left_g, left_h = left_g + bins.get(k, (0, 0))[0], left_h + bins.get(k, (0, 0))[1]
            right_g, right_h = g - left_g, h - left_h
            if left_h < 1e-3 or right_h < 1e-3:
                continue
            found = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - g**2 / (h + RIDGE)
            if found > gain:
                best, gain = (name, edge), found
    return best


def _grow(sample: DataFrame, edges: dict[str, list[float]], margin: Column) -> object:
    """One tree: a level is one aggregate over the sample."""
    chance = 1 / (1 + F.exp(-margin))
    rows = sample.withColumns({"_g": F.col("_w") * (F.col("_y") - chance), "_h": F.col("_w") * chance * (1 - chance)})
    tree: object = 0  # leaves are numbered until they get values
    leaves, values = 1, {0: 0.0}
    for level in range(DEPTH + 1):
        cells = F.explode(F.array(*[F.struct(F.lit(x).alias("f"), F.col(f"_bin_{x}").alias("b")) for x in FEATURES])).alias("cell")
        node = _expression(tree, lambda leaf: F.lit(leaf)).alias("node")
        sums: dict = {}
        for row in rows.select(node, "_g", "_h", cells).groupBy("node", "cell").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h")).collect():
            sums.setdefault(row["node"], {}).setdefault(row["cell"]["f"], {})[row["cell"]["b"]] = (row["g"], row["h"])
        splits = {}
        for key, own in sums.items():
            bins = own[FEATURES[0]].values()
            values[key] = RATE * sum(x[0] for x in bins) / (sum(x[1] for x in bins) + RIDGE)
            if level < DEPTH and (split := _best(own, edges)):
                splits[key] = split
        if not splits:
            break

        def divide(part):
            nonlocal leaves
            if isinstance(part, tuple):
                return (*part[:2], divide(part[2]), divide(part[3]))
            if part not in splits:
                return part
            leaves += 2
            return (*splits[part], leaves - 2, leaves - 1)

        tree = divide(tree)

    def valued(part):
        return (*part[:2], valued(part[2]), valued(part[3])) if isinstance(part, tuple) else float(values.get(part, 0.0))

    return valued(tree)


def train(labelled: DataFrame, size: int, blocked: int, sample_rows: int = SAMPLE) -> Trees:
    """Trees from rows with features and ``ruled``; ``size`` and ``blocked`` are how many there are, and how many block."""
    if not blocked or blocked == size:
        return Trees(math.inf if size and blocked == size else -math.inf)
    draw = F.pmod(F.xxhash64("url", F.lit("draw")), F.lit(1 << 20)) / (1 << 20)
    blocks = F.col("ruled") == "block"
    weight = F.when(blocks, 0.5 * size / blocked).otherwise(0.5 * size / (size - blocked))
    sample = labelled.filter(draw < min(1.0, sample_rows / size)).select(*FEATURES, blocks.cast("double").alias("_y"), weight.alias("_w"))
    sample = materialize(sample, "labelled")
    # Cuts come from each verdict by itself, so the rarer one is seen however rare it is, and so do the extremes.
    cuts = [k / BINS for k in range(BINS + 1)]
    found = sample.groupBy("_y").agg(*[F.percentile_approx(x, cuts, 10_000).alias(x) for x in FEATURES]).collect()
    # Of a feature with few values all count, also one that is rare in either verdict.
    few = sample.agg(*[F.approx_count_distinct(x).alias(x) for x in FEATURES]).first()
    few = [x for x in FEATURES if few[x] <= 2 * BINS]
    every = sample.agg(*[F.collect_set(x).alias(x) for x in few]).first() if few else {}
    # Edges lie between values, so a value that the sample lacks goes to the nearer side.
    values = {x: sorted(set(every[x]) if x in few else {v for row in found for v in row[x] or []}) for x in FEATURES}
    edges = {x: [(a + b) / 2 for a, b in zip(v, v[1:])] for x, v in values.items()}
    binned = sample.withColumns(
        {f"_bin_{x}": sum((F.when(F.col(x) > F.lit(e), 1).otherwise(0) for e in edges[x]), F.lit(0)).cast("int") for x in FEATURES}
    )
    binned = materialize(binned, "binned")
    model = Trees()
    for _ in range(TREES):
        model.trees.append(_grow(binned, edges, model.margin()))
    return model


def judge(pages: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score (what the trees say) of every row."""
    rows = lexical(with_rule(parse(pages.select("page_id", "url")), rules))
    ruled = rows.select("ruled").groupBy("ruled").count().collect()
    sizes = {row["ruled"]: row["count"] for row in ruled}
    blocked, size = sizes.get("block", 0), sizes.get("block", 0) + sizes.get("allow", 0)
    rows = with_suffix_statistics(rows, blocked, size - blocked)
    model = train(rows.filter(F.col("ruled").isNotNull()), size, blocked, sample_rows)
    scored = rows.withColumn("block_score", 1 / (1 + F.exp(-model.margin())) if math.isfinite(model.base) else F.lit(float(model.base > 0)))
    verdict = F.coalesce("ruled", F.when(F.col("block_score") > 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")
