"""Classification rules over titles, companies and descriptions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstrata import vocab
from jobstrata.functions.text import contains_any, first_match, first_pattern, present

# A word ends where neither a plain letter, a digit nor an accented letter follows.
_EDGE = "a-z0-9à-öø-ÿ"


def seniority(title: Column, words: dict[str, list[str]] = vocab.SENIORITY_WORDS) -> Column:
    """Level named in the title as a whole word, from the top level down; Pleno otherwise."""
    patterns = {
        level: f"(^|[^{_EDGE}])({'|'.join(map(re.escape, names))})([^{_EDGE}]|$)" for level, names in words.items()
    }
    return first_pattern(F.lower(title), patterns, F.lit("Pleno"))


def seniority_substring(title: Column) -> Column:
    """The same levels matched inside words too ('leadership' counts as Senior)."""
    return first_pattern(F.lower(title), vocab.SENIORITY_SUBSTRINGS, F.lit("Pleno"))


def seniority_legacy(title: Column) -> Column:
    """Case-sensitive names of three levels."""
    # Level names and the text for none of them.
    levels = {"Senior": ["Sênior", "Senior"], "Pleno": ["Pleno"], "Junior": ["Junior", "Jr"]}
    return first_match(title, levels, F.lit("Não especificado"))


def contract_type(title: Column) -> Column:
    return first_match(F.lower(title), vocab.CONTRACT_WORDS, F.lit("N/A"))


def job_type(c: Column) -> Column:
    """Normalised job type; NULL has its own label and unknown text stays as it is."""
    return F.when(c.isNull(), vocab.JOB_TYPE_MISSING).otherwise(
        first_pattern(F.lower(c), vocab.JOB_TYPE_PATTERNS, c)
    )


def company_name(c: Column, whole_word: bool = True) -> Column:
    """Drop a trailing legal form; by default only when a separator stands before it."""
    before = r"[ \t,]+" if whole_word else ""
    return F.trim(F.regexp_replace(c, rf"(?i){before}({'|'.join(vocab.COMPANY_SUFFIXES)})$", ""))


def tech_stack(text: Column, keywords: list[str] = vocab.TECH_KEYWORDS, whole_word: bool = True) -> Column:
    """Keywords found in the text, in list order, without repeats.

    Plain alphanumeric keywords are looked up among the words of the text, which is cut up
    once; only keywords with other characters need a pattern of their own.
    """
    lowered = F.lower(text)
    if not whole_word:
        found = F.array_compact(F.array(*[F.when(F.contains(lowered, F.lit(k)), F.lit(k)) for k in keywords]))
    elif all(re.fullmatch("[a-z0-9]+", k) for k in keywords):
        found = F.array_intersect(F.array(*[F.lit(k) for k in keywords]), F.split(lowered, "[^a-z0-9]+"))
    else:
        found = F.array_compact(
            F.array(
                *[
                    F.when(
                        F.contains(lowered, F.lit(k)) & lowered.rlike(f"(^|[^a-z0-9]){re.escape(k)}([^a-z0-9]|$)"),
                        F.lit(k),
                    )
                    for k in keywords
                ]
            )
        )
    return F.coalesce(found, F.array().cast("array<string>"))


def main_technology(skills: Column) -> Column:
    return F.coalesce(F.get(skills, F.lit(0)), F.lit("N/A"))


def work_modality(*texts: Column) -> Column:
    """Modality named anywhere in the given texts."""
    joined = F.lower(F.concat_ws(" ", *texts))
    return first_match(joined, vocab.MODALITY_WORDS, F.lit("N/A"))


def listing_modality(location: Column) -> Column:
    """Modality read off the location: remote, hybrid, on-site when there is one, else NULL."""
    lowered = F.lower(location)
    return (
        F.when(F.contains(lowered, F.lit("remote")), "remote")
        .when(F.contains(lowered, F.lit("hybrid")), "hybrid")
        .when(present(location), "onsite")
    )


def alert_priority(title: Column) -> Column:
    high = contains_any(F.lower(title), vocab.HIGH_PRIORITY_WORDS)
    return F.when(high, "HIGH").otherwise("MEDIUM")


def error_recommendation(message: Column) -> Column:
    """What to do about an error message; NULL when nothing is known."""
    out = None
    for parts, advice in vocab.ERROR_RECOMMENDATIONS:
        hit = F.lit(True)
        for part in parts:
            hit = hit & F.contains(message, F.lit(part))
        out = F.when(hit, advice) if out is None else out.when(hit, advice)
    return out
