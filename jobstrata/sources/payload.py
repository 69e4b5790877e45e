"""API payloads with nested company objects, flattened to postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata import schemas, vocab
from jobstrata.functions.classify import listing_modality
from jobstrata.functions.dates import AsOf, as_timestamp, is_recent_listing, not_before, parse_timestamp
from jobstrata.functions.location import parse_listing, rebuild_location
from jobstrata.functions.salary import payload_has_salary
from jobstrata.functions.text import payload_quality, present


def first_given(*columns: Column) -> Column:
    """First of several alternative fields that is there, else empty text."""
    return F.coalesce(*columns, F.lit(""))


def payload_items(df: DataFrame, value: str = "value") -> DataFrame:
    """One row per item of each payload's ``data`` list; other columns are kept."""
    others = [c for c in df.columns if c != value]
    parsed = df.select(*others, F.from_json(F.col(value), schemas.PAYLOAD).alias("_payload"))
    return parsed.select(*others, F.inline("_payload.data"))


def company_field(company: Column, field: str) -> Column:
    """A field of the company object; plain text is the company's name."""
    is_object = F.coalesce(F.startswith(F.ltrim(company), F.lit("{")), F.lit(False))
    from_object = F.from_json(F.when(is_object, company), schemas.PAYLOAD_COMPANY)[field]
    plain = company if field == "name" else F.lit("")
    return F.coalesce(F.when(is_object, from_object).otherwise(plain), F.lit(""))


def normalize_items(items: DataFrame, search_term: Column, as_of: AsOf = None) -> DataFrame:
    """Flat postings from payload items; items with neither title nor url are dropped."""
    c = F.col
    place = parse_listing(c("location"), c("city"), c("state"), c("country"))
    staged = items.select(
        "*",
        place.alias("_place"),
        first_given(c("listed_at"), c("posted_at")).alias("_posted"),
        first_given(c("url"), c("link")).alias("_url"),
        first_given(c("title")).alias("_title"),
        listing_modality(c("location")).alias("_modality"),
        company_field(c("company"), "name").alias("_company"),
        as_timestamp(as_of).alias("_now"),
    )
    posted = parse_timestamp(c("_posted"))
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    given = present(c("_posted"))
    flat = staged.select(
        first_given(c("id"), c("job_id")).alias("job_id"),
        c("_title").alias("job_title"),
        c("_title").alias("title"),
        c("_company").alias("company_name"),
        c("_company").alias("company"),
        rebuild_location(c("location"), c("_place.city"), c("_place.state"), c("country")).alias("location"),
        c("_url").alias("job_url"),
        c("_url").alias("url"),
        c("_place.city").alias("city"),
        c("_place.state").alias("state"),
        c("_place.country").alias("country"),
        c("_posted").alias("posted_date"),
        # A date that cannot be read counts as just seen.
        F.when(given, F.date_format(F.coalesce(posted, c("_now")), iso)).alias("posted_time_ts"),
        (given & is_recent_listing(F.coalesce(posted, c("_now")), as_of)).alias("is_recent_posting"),
        c("_modality").alias("work_modality"),
        F.coalesce(c("contract_type"), c("job_type")).alias("contract_type"),
        c("salary_min"),
        c("salary_max"),
        c("salary_range"),
        payload_has_salary(c("salary_min"), c("salary_max"), c("salary_range")).alias("has_salary_info"),
        F.substring(first_given(c("description")), 1, vocab.PAYLOAD_SNIPPET_CHARS).alias("description_snippet"),
        company_field(c("company"), "id").alias("company_id"),
        company_field(c("company"), "url").alias("company_url"),
        F.coalesce(c("_modality") == "remote", F.lit(False)).alias("is_remote"),
        F.coalesce(c("is_easy_apply"), c("easy_apply"), F.lit(False)).alias("is_easy_apply"),
        F.coalesce(c("is_promote"), c("is_promoted"), F.lit(False)).alias("is_promoted"),
        F.lit("api").alias("extraction_method"),
        F.date_format(c("_now"), iso).alias("extraction_timestamp"),
        search_term.alias("search_term"),
        payload_quality(c("description")).alias("description_quality_score"),
    )
    return flat.filter(present(c("job_title")) | present(c("job_url")))


def normalize_api_payload(df: DataFrame, search_term: str, as_of: AsOf = None, value: str = "value") -> DataFrame:
    """Payload JSON text to flat postings."""
    return normalize_items(payload_items(df.select(value), value), F.lit(search_term), as_of)


def search_postings(
    df: DataFrame, keyword: str, text: str, ts: str, as_of: AsOf = None, within: str | None = "7 days",
    remote: Column | None = None, limit: int | None = 100, tiebreak: str = "job_id",
) -> DataFrame:
    """Newest postings that hold the keyword, at most ``within`` old, optionally remote only; all of them without a limit."""
    out = df.filter(F.contains(F.lower(F.col(text)), F.lit(keyword.lower())))
    if within is not None:
        out = out.filter(not_before(out, ts, as_of, within))
    if remote is not None:
        out = out.filter(remote)
    out = out.orderBy(F.desc_nulls_last(ts), F.asc(tiebreak))
    return out if limit is None else out.limit(limit)
