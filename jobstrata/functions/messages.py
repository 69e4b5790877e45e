"""Texts sent to readers and the replies they send back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstrata import vocab
from jobstrata.functions.classify import alert_priority
from jobstrata.functions.text import WHITESPACE


def notification_text(
    job_id: Column, title: Column, company: Column, modality: Column, posted: Column, url: Column
) -> Column:
    return F.format_string(
        vocab.NOTIFICATION_FORMAT, job_id, title, company, modality, F.date_format(posted, "dd/MM/yyyy"), url
    )


def numbered_text(
    number: Column, total: Column, domain: Column, title: Column, company: Column,
    modality: Column, job_id: Column, url: Column,
) -> Column:
    return F.format_string(
        vocab.NUMBERED_NOTIFICATION_FORMAT,
        number, total, domain, title, company, modality, F.substring(job_id, 1, 10), url,
    )


def parse_reply(text: Column) -> Column:
    """Struct of ``valid``, ``decision`` and ``job_id``.

    A reply is valid with two or more words of which the first is SIM or NAO. Only that
    word is upper-cased: ids keep their case.
    """
    words = F.split(F.trim(F.regexp_replace(text, WHITESPACE, " ")), " ")
    decision = F.upper(F.get(words, F.lit(0)))
    valid = F.coalesce((F.size(words) >= 2) & decision.isin("SIM", "NAO"), F.lit(False))
    return F.struct(
        valid.alias("valid"),
        F.when(valid, decision).alias("decision"),
        F.when(valid, F.get(words, F.lit(1))).alias("job_id"),
    )


def alert_payload(category: Column, title: Column, company: Column, job: Column, at: Column) -> Column:
    """Alert about a new posting, as JSON text."""
    missing = F.lit("N/A")
    return F.to_json(
        F.struct(
            F.lit("NEW_JOB").alias("alert_type"),
            at.alias("timestamp"),
            category.alias("category"),
            job.alias("job_data"),
            F.format_string(vocab.ALERT_FORMAT, F.coalesce(title, missing), F.coalesce(company, missing)).alias(
                "message"
            ),
            alert_priority(title).alias("priority"),
        )
    )
