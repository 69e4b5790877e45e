"""Text and number rules, Column to Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstrata import vocab

WHITESPACE = r"[ \t\n\x0B\f\r]+"


def normalize_text(c: Column) -> Column:
    """Collapse white space, trim, lower-case."""
    return F.lower(F.trim(F.regexp_replace(c, WHITESPACE, " ")))


def lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c))


def present(c: Column) -> Column:
    """True when the text is neither NULL nor empty; never NULL itself."""
    return c.isNotNull() & (c != "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def safe_double(c: Column) -> Column:
    """Drop everything but digits, dot and minus; what is still no number becomes NULL."""
    return F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double")


def contains_any(c: Column, parts: list[str]) -> Column:
    """True when ``c`` holds any of the parts; NULL text gives NULL."""
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(p)) for p in parts])


def first_match(c: Column, words: dict[str, list[str]], default: Column) -> Column:
    """Label of the first entry whose words occur in ``c``."""
    out = None
    for label, parts in words.items():
        hit = contains_any(c, parts)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(default)


def first_pattern(c: Column, patterns: dict[str, str], default: Column) -> Column:
    """Label of the first entry whose pattern is found in ``c``."""
    out = None
    for label, pattern in patterns.items():
        hit = c.rlike(pattern)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(default)


def snippet(c: Column, chars: int = vocab.SNIPPET_CHARS) -> Column:
    return F.when(F.length(c) > chars, F.concat(F.substring(c, 1, chars), F.lit("..."))).otherwise(c)


def description_quality(length: Column) -> Column:
    """Band by description length; an unknown length counts as low."""
    return (
        F.when(length > vocab.LONG_DESCRIPTION, "high")
        .when(length > vocab.MEDIUM_DESCRIPTION, "medium")
        .otherwise("low")
    )


def payload_quality(description: Column) -> Column:
    return F.when(present(description), "high").otherwise("low")


def posting_id(title: Column, company: Column, location: Column, prefix: str = "job_", digits: int = 32) -> Column:
    """Id that depends on content only, so one posting keeps its id on every run.

    The whole digest is the key. Eight hex digits make a readable form for display only: they
    start to collide at some ten thousand postings.
    """
    content = F.concat_ws("_", *[F.coalesce(c, F.lit("")) for c in (title, company, location)])
    return F.concat(F.lit(prefix), F.substring(F.md5(content), 1, digits))


def batch_id(category: Column, extract_date: Column, ts: Column) -> Column:
    return F.concat_ws("_", category, extract_date.cast("string"), F.date_format(ts, "HHmmss"))


def search_relevant(title: Column, term: Column) -> Column:
    """At least half (and at least one) of the term's words occur in the title."""
    words = F.split(normalize_text(term), " ")
    hits = F.size(F.filter(words, lambda w: F.contains(F.lower(title), w)))
    needed = F.greatest(F.lit(1), F.floor(F.size(words) / 2).cast("int"))
    return present(normalize_text(term)) & F.coalesce(hits >= needed, F.lit(False))


def title_relevant(title: Column, category: Column, terms: dict[str, list[str]] | None = None) -> Column:
    """Title holds a key term of its category; other categories pass, empty titles fail."""
    terms = vocab.RELEVANT_TERMS if terms is None else terms
    lowered = F.lower(title)
    rule = None
    for name, words in terms.items():
        here = category == name
        hit = contains_any(lowered, words)
        rule = F.when(here, hit) if rule is None else rule.when(here, hit)
    known = rule.otherwise(True) if rule is not None else F.lit(True)
    return present(title) & known
