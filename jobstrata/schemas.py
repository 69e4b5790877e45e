"""Input schemas and the ordered column contracts of each layer."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType(),
    "double": T.DoubleType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(),
}


def struct(fields: str) -> T.StructType:
    """Schema from ``name type`` pairs, without the session that Spark's own parser needs."""
    pairs = [f.split() for f in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Raw posting, one JSON object per line.
RAW_POSTING = struct(
    "job_id string, title string, company string, location string, description string, "
    "description_snippet string, description_length bigint, url string, posted_time string, "
    "extract_timestamp string, source string, search_term string, category string, "
    "location_country string, has_company boolean, salary_min string, salary_max string, "
    "has_salary boolean, work_modality string, contract_type string"
)

# Message value: the raw posting plus five fields the producer adds.
MESSAGE = T.StructType(
    RAW_POSTING.fields
    + struct(
        "posted_date string, extract_date string, is_new boolean, batch_id string, type string"
    ).fields
)

# Message envelope as a broker delivers it.
_PLACE = [T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())]
ENVELOPE = T.StructType(struct("key binary, value binary").fields + _PLACE + struct("timestamp timestamp").fields)

# API payload: the company arrives as an object or as plain text, so it is read as text first.
PAYLOAD_ITEM = struct(
    "id string, job_id string, title string, company string, location string, city string, "
    "state string, country string, url string, link string, listed_at string, posted_at string, "
    "contract_type string, job_type string, salary_min string, salary_max string, "
    "salary_range string, description string, is_easy_apply boolean, easy_apply boolean, "
    "is_promote boolean, is_promoted boolean"
)
PAYLOAD = T.StructType().add("success", T.BooleanType()).add("data", T.ArrayType(PAYLOAD_ITEM))
PAYLOAD_COMPANY = struct("name string, id string, url string")

BRONZE_ROW = T.StructType(
    RAW_POSTING.fields
    + [T.StructField("_rescued_data", T.MapType(T.StringType(), T.StringType()))]
    + struct("ingestion_timestamp timestamp, source_file string, extract_date string").fields
)
BRONZE = BRONZE_ROW.fieldNames()

SILVER_STG = (
    "job_id title company location description description_snippet description_length url "
    "posted_time posted_time_ts extract_timestamp extract_ts source search_term category "
    "location_country has_company salary_min salary_max has_salary work_modality contract_type "
    "extract_date ingestion_timestamp processed_timestamp source_file _rescued_data"
).split()

SILVER_MD = (
    "job_id title company city state country location location_country category search_term "
    "work_modality contract_type salary_min salary_max salary_range has_salary has_salary_info "
    "posted_time posted_time_ts extract_timestamp extract_ts description description_snippet "
    "description_length description_quality_score url extract_date ingestion_timestamp "
    "processed_timestamp source_file"
).split()

GOLD = (
    "job_id title company city state country location_tier category search_term work_modality "
    "contract_type salary_min salary_max salary_range has_salary_info is_premium_salary "
    "posted_time_ts is_recent_posting description_quality_score url ingestion_timestamp"
).split()

GOLD_ALL = ["domain"] + GOLD + ["effective_posted_time"]

STATE = struct("last_posted_time_ts timestamp")
SENT = struct(
    "job_id string, title string, company string, work_modality string, url string, "
    "posted_time_ts timestamp, notified_ts timestamp"
)
RESPONSES = struct(
    "job_id string, decision string, decision_ts timestamp, responder string, title string, "
    "company string, work_modality string, url string"
)
