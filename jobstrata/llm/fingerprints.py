"""Document fingerprints: SimHash of weighted terms, and permuted block tables that find near ones. DataFrame functions only.

Terms are pairs of neighbouring words (runs of anything but white space, in lower case), a lone word stands for itself. A
term weighs as many letters as it has, up to ``HEAVIEST``, so that rare long words count more than articles and no endless
word outvotes a text. The hash of a term votes with its weight on ``BITS`` signed bits.

Likeness is the cosine that the share of differing bits stands for: 1 for equal fingerprints, 0 for unrelated ones.

``near`` cuts fingerprints into blocks. Within a radius of r bits, b blocks agree in b - r at least; there is one table per
choice of that many blocks, keyed by their bits, and a query meets the fingerprints under its own keys only.

Null texts count as empty; a text without words has fingerprint zero. Repeated rows (same doc_id, same text) get the
same result each and count once in the order; different texts under one doc_id are ordered by a digest. A null doc_id
comes last in the order. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import hex16, materialize, text_or_empty
from jobstrata.llm.neighbours import with_next
from jobstrata.llm.votes import differing, majority, vote_sums
from jobstrata.operators.joins import attach_lookup

BITS = 128
HEAVIEST = 32
RADIUS = 3
BLOCKS = 5


def simhash(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, low and high: both halves of the fingerprint of each group of ``keys``."""
    words = F.filter(F.split(F.lower(F.col(text)), r"\s+"), lambda w: w != "")
    split = rows.select(*keys, words.alias("words"))
    last = F.greatest(F.size("words") - 2, F.lit(0))
    places = F.explode_outer(F.when(F.size("words") > 0, F.sequence(F.lit(0), last)))
    each = split.select(*keys, "words", places.alias("place"))
    term = F.when(F.col("place").isNotNull(), F.array_join(F.slice("words", F.col("place") + 1, F.lit(2)), " "))
    terms = each.select(*keys, term.alias("term"))
    weight = F.least(F.length("term"), F.lit(HEAVIEST)).cast("long")
    hashed = [F.when(F.col("term").isNotNull(), F.xxhash64(*x)) for x in (["term"], ["term", F.lit(1)])]
    terms = terms.select(*keys, weight.alias("weight"), hashed[0].alias("h"), hashed[1].alias("g"))
    votes = terms.groupBy(*keys).agg(
        F.sum("weight").alias("total"),
        *vote_sums(F.col("h"), F.col("weight"), "h"),
        *vote_sums(F.col("g"), F.col("weight"), "g"),
    )
    return votes.select(*keys, majority(F.col("total"), "h").alias("low"), majority(F.col("total"), "g").alias("high"))


def distance(low: Column, high: Column, other_low: Column, other_high: Column) -> Column:
    return differing(low, other_low) + differing(high, other_high)


def likeness(bits: Column) -> Column:
    """Cosine of the angle that the differing bits measure, at least 0."""
    return F.greatest(F.cos(bits * F.lit(3.141592653589793 / BITS)), F.lit(0.0))


def _tables(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Fingerprints under one key per table: the number of the choice of blocks and their hex digits."""
    digits = F.concat(hex16("high"), hex16("low"))
    edges = [BITS // 4 * k // blocks for k in range(blocks + 1)]
    cut = [F.substring(digits, edges[k] + 1, edges[k + 1] - edges[k]) for k in range(blocks)]
    keys = [
        F.concat(F.lit(f"{number}:"), *[cut[k] for k in chosen])
        for number, chosen in enumerate(combinations(range(blocks), blocks - radius))
    ]
    return prints.withColumn("key", F.explode(F.array(*keys)))


def near(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs (low, high, other_low, other_high, bits) of distinct queries and distinct ``prints`` within the radius."""
    if not 0 <= radius < blocks:
        raise ValueError("there must be more blocks than differing bits")
    asked = _tables(queries.select("low", "high").distinct(), radius, blocks)
    known = prints.select("low", "high").distinct()
    known = _tables(known, radius, blocks).select("key", F.col("low").alias("other_low"), F.col("high").alias("other_high"))
    bits = distance(F.col("low"), F.col("high"), F.col("other_low"), F.col("other_high"))
    met = asked.join(known, "key").withColumn("bits", bits).filter(F.col("bits") <= radius)
    return met.select("low", "high", "other_low", "other_high", "bits").distinct()


def near_counts(prints: DataFrame, asked: Column, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """low, high and near_docs: how many rows have a fingerprint within the radius of a row chosen by ``asked``, itself included."""
    sizes = prints.groupBy("low", "high").agg(F.count("*").alias("n"))
    pairs = near(prints.filter(asked), sizes, radius, blocks)
    sizes = sizes.select(F.col("low").alias("other_low"), F.col("high").alias("other_high"), "n")
    met = attach_lookup(pairs, sizes, ["other_low", "other_high"], ["n"])
    return met.groupBy("low", "high").agg(F.sum("n").alias("near_docs"))


KEYS = ["no_id", "key_id", "tie"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows under a key without nulls that sorts by doc_id, rows without one last."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.select(
        F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("key_id"), F.xxhash64("text").alias("tie"), "text"
    )


def compare_edited(docs: DataFrame, every: int, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last floor(n / 2) code points replaced by the first as many of the next document. Result:
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and near_docs: for a doc_id
    divisible by ``every``, how many documents have a fingerprint within the radius of its own, itself included; else null.
    """
    rows = _keyed(docs)
    prints = materialize(simhash(rows, KEYS), "fingerprints")
    lengths = rows.select(*KEYS, F.length("text").alias("n")).groupBy(*KEYS).agg(F.max("n").alias("n"), F.count("*").alias("copies"))
    order = materialize(with_next(lengths, KEYS), "order")

    # One shuffle brings each text to its key, and both uses of it read that shuffle. There it is halved, and what the
    # document before wants of it is cut off, which is the only text that moves a second time.
    texts = rows.groupBy(*KEYS).agg(F.first("text").alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    staying = F.substring("text", F.lit(1), F.length("text") - half)
    base = texts.select(*KEYS, F.length("text").cast("long").alias("n_chars"), staying.alias("staying"))
    wanted = F.floor(F.col("n") / 2).cast("int").alias("wanted")
    wanted = order.select(F.col("next.*"), F.struct(*KEYS, "copies").alias("by"), wanted)
    heads = texts.join(wanted, KEYS).select("by.*", F.substring("text", F.lit(1), F.col("wanted")).alias("head"))
    edited = base.join(heads, KEYS).select(*KEYS, "copies", "n_chars", F.concat("staying", "head").alias("text"))
    kept = [*KEYS, "copies", "n_chars", "edited_sha256"]
    changed = simhash(edited.withColumn("edited_sha256", F.sha2("text", 256)), kept)

    own = prints.select(*KEYS, F.col("low").alias("own_low"), F.col("high").alias("own_high"))
    after = prints.join(wanted, KEYS).select(*[f"by.{x}" for x in KEYS], F.col("low").alias("next_low"), F.col("high").alias("next_high"))
    out = changed.join(own, KEYS).join(after, KEYS)
    is_asked = ~F.col("no_id") & (F.col("key_id") % every == 0)
    found = near_counts(prints, is_asked, radius).withColumn("asked", F.lit(True))
    found = found.select(F.col("low").alias("own_low"), F.col("high").alias("own_high"), "asked", "near_docs")
    out = attach_lookup(out.withColumn("asked", is_asked), found, ["own_low", "own_high", "asked"], ["near_docs"])
    to = lambda low, high: likeness(distance(F.col("own_low"), F.col("own_high"), F.col(low), F.col(high)))
    one = out.select(
        F.when(~F.col("no_id"), F.col("key_id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        F.concat(hex16("own_high"), hex16("own_low")).alias("fingerprint"),
        F.concat(hex16("high"), hex16("low")).alias("edited_fingerprint"),
        to("low", "high").alias("near_edited"),
        to("next_low", "next_high").alias("near_next"),
        "near_docs",
        "copies",
    )
    return one.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "copy")
