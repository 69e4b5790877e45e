"""Projection, filter and classification rules over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata import vocab
from jobstrata.catalog.base import EVENTS_DAY, ORDERS_DAY, POSTINGS_DAY, over_postings, postings, query, table
from jobstrata.functions import classify, dates, location, messages, salary, text
from jobstrata.operators import quality
from jobstrata.plans import jobs, medallion, monitoring
from jobstrata.sources.messages import stream_gate
from jobstrata.sources.payload import first_given, search_postings

c = F.col

# Words of the test corpus in place of technology names; the last one never occurs.
CORPUS_KEYWORDS = ["the", "of", "der", "des", "und", "this", "et", "r", "a", "zzyzx"]
# Title words of the test tables per category; other categories have no list.
CORPUS_TERMS = {"data_engineer": ["widget", "bolt", "gear"], "data_analytics": ["ring", "plate"]}
# City names of the test tables.
CORPUS_TIER_1 = ["NATION_1", "NATION_2", "NATION_3"]
CORPUS_TIER_2 = ["NATION_4", "NATION_5"]
CORPUS_CITY_PARTS = ["_1", "_20", "_3"]
CORPUS_CITIES = ["nation_1", "nation_7", "nation_12"]

KEYWORDS_SQL = "[" + ", ".join(f"'{k}'" for k in CORPUS_KEYWORDS) + "]"
TECH_STACK_SQL = (
    f"list_filter({KEYWORDS_SQL}, lambda k: regexp_matches(lower(description), "
    "'(^|[^a-z0-9])' || k || '([^a-z0-9]|$)'))"
)
SENIORITY_SQL = (
    "CASE WHEN regexp_matches(lower(title), '(^|[^a-z0-9à-öø-ÿ])(principal|architect|head|director)([^a-z0-9à-öø-ÿ]|$)') THEN 'Principal' "
    "WHEN regexp_matches(lower(title), '(^|[^a-z0-9à-öø-ÿ])(senior|sênior|sr|iii|lead)([^a-z0-9à-öø-ÿ]|$)') THEN 'Senior' "
    "WHEN regexp_matches(lower(title), '(^|[^a-z0-9à-öø-ÿ])(pleno|mid|ii)([^a-z0-9à-öø-ÿ]|$)') THEN 'Pleno' "
    "WHEN regexp_matches(lower(title), '(^|[^a-z0-9à-öø-ÿ])(junior|júnior|jr|trainee|entry)([^a-z0-9à-öø-ÿ]|$)') THEN 'Junior' "
    "ELSE 'Pleno' END"
)
JOB_TYPE_SQL = (
    "CASE WHEN type IS NULL THEN 'Não informado' "
    "WHEN regexp_matches(lower(type), 'full.?time|integral|clt') THEN 'CLT' "
    "WHEN regexp_matches(lower(type), 'part.?time|meio.?periodo') THEN 'Meio período' "
    "WHEN regexp_matches(lower(type), 'contract|temporario|freelance') THEN 'Temporário' "
    "WHEN regexp_matches(lower(type), 'remote|remoto') THEN 'Remoto' "
    "WHEN regexp_matches(lower(type), 'hybrid|hibrido') THEN 'Híbrido' ELSE type END"
)
COMPANY_SQL = "trim(regexp_replace(company, '(?i)[ \\t,]+(ltda|lt|sa|s\\.a|inc|corp|corporation)$', ''))"
GENERAL_PARTS_SQL = "string_split(regexp_replace(location, '[ \\t]*-[ \\t]*', ',', 'g'), ',')"
GENERAL_PLACE_SQL = (
    f"trim({GENERAL_PARTS_SQL}[1]) AS city, trim({GENERAL_PARTS_SQL}[2]) AS state, "
    f"coalesce(trim({GENERAL_PARTS_SQL}[3]), 'Brasil') AS country"
)


def spread(df, key, struct):
    """A struct column as plain columns next to the key."""
    return df.select(key, struct.alias("s")).select(key, "s.*")


@query(
    "b01_text_normalised",
    r"SELECT doc_id, lower(trim(regexp_replace(text, '[ \t\n\v\f\r]+', ' ', 'g'))) AS norm, lower(trim(source)) AS src FROM documents",
)
def b01(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", text.normalize_text(c("text")).alias("norm"), text.lower_trim(c("source")).alias("src"))


@query(
    "b02_timestamp_typed",
    """WITH t AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS raw FROM events)
    SELECT event_id, try_cast(raw AS timestamp) AS ts_typed FROM t""",
)
def b02(spark, sf):
    raw = F.when(c("event_id") % 7 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return table(spark, sf, "events").select("event_id", dates.parse_timestamp(raw).alias("ts_typed"))


@query(
    "b03_safe_number",
    r"""SELECT c_custkey, try_cast(regexp_replace(raw, '[^0-9.\-]', '', 'g') AS double) AS amount FROM (
    SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '-' WHEN 1 THEN '' ELSE 'R$ ' || CAST(c_acctbal AS decimal(12,2)) END AS raw FROM customer)""",
)
def b03(spark, sf):
    raw = F.expr("CASE c_custkey % 5 WHEN 0 THEN '-' WHEN 1 THEN '' ELSE 'R$ ' || CAST(c_acctbal AS decimal(12,2)) END")
    return table(spark, sf, "customer").select("c_custkey", text.safe_double(raw).alias("amount"))


def raw_postings(spark, sf):
    """The posting view in the shape of raw posting files."""
    pv = postings(spark, sf, "title", "place", "posted", "ingested", "salary")
    return pv.select(
        "job_id", "title", "company", "location", "description",
        text.snippet(c("description")).alias("description_snippet"), "description_length", "url",
        F.date_format("posted_time_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("posted_time"),
        F.date_format("ingestion_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("extract_timestamp"),
        "source", c("lang").alias("search_term"), "category", "location_country",
        F.lit(True).alias("has_company"),
        F.concat(F.lit("R$ "), c("salary_low").cast("string")).alias("salary_min"),
        F.concat(F.lit("R$ "), c("salary_high").cast("string")).alias("salary_max"),
        "has_salary", F.lit("N/A").alias("work_modality"), classify.contract_type(c("title")).alias("contract_type"),
        F.lit(None).cast("map<string,string>").alias("_rescued_data"),
        c("ingestion_timestamp").cast("timestamp").alias("ingestion_timestamp"),
        F.lit("view").alias("source_file"),
        F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("extract_date"),
    )


# Gold rows over the posting view, stated independently of the layer functions.
GOLD_SQL = r"""n AS (SELECT *, lower(trim(regexp_replace(title, '[ \t\n\v\f\r]+', ' ', 'g'))) AS t,
    lower(trim(regexp_replace(company, '[ \t\n\v\f\r]+', ' ', 'g'))) AS co,
    lower(trim(regexp_replace(location, '[ \t\n\v\f\r]+', ' ', 'g'))) AS lo,
    lower(trim(location_country)) AS lc, CAST(salary_low AS double) AS smin, CAST(salary_high AS double) AS smax FROM pv),
  g AS (SELECT *, string_split(regexp_replace(lo, '[ \t]*-[ \t]*', ',', 'g'), ',') AS parts FROM n
    WHERE job_id <> '' AND t <> '' AND co <> '' AND lo <> ''),
  gold AS (SELECT job_id, t AS title, co AS company,
    CASE WHEN lo IN ('brasil', 'brazil') THEN NULL ELSE trim(parts[1]) END AS city,
    CASE WHEN len(parts) >= 2 THEN trim(parts[2]) END AS state,
    CASE WHEN lo IN ('brasil', 'brazil') THEN lo ELSE coalesce(trim(parts[3]), lc) END AS country,
    'tier_3' AS location_tier, category, lang AS search_term, 'N/A' AS work_modality,
    CASE WHEN contains(lower(title), 'estágio') THEN 'Estágio' WHEN contains(lower(title), 'junior') THEN 'Júnior'
         WHEN contains(lower(title), 'senior') THEN 'Sênior' WHEN contains(lower(title), 'pleno') THEN 'Pleno'
         WHEN contains(lower(title), 'freela') THEN 'Freelance' ELSE 'N/A' END AS contract_type,
    smin AS salary_min, smax AS salary_max, smax - smin AS salary_range,
    coalesce(has_salary, smin IS NOT NULL OR smax IS NOT NULL) AS has_salary_info,
    coalesce(smin > 8000, false) AS is_premium_salary, posted_time_ts,
    date_diff('day', CAST(posted_time_ts AS date), DATE '2001-08-02') <= 30 AS is_recent_posting,
    CASE WHEN description_length > 500 THEN 'high' WHEN description_length > 200 THEN 'medium' ELSE 'low' END AS description_quality_score,
    url, ingestion_timestamp FROM g)"""
ALL_PARTS = ("title", "place", "posted", "ingested", "salary")


@query("b04_layer_contract_gold", over_postings(*ALL_PARTS, more=GOLD_SQL, body="SELECT * FROM gold"))
def b04(spark, sf):
    return medallion.refine(raw_postings(spark, sf), as_of=ORDERS_DAY)


@query(
    "b05_critical_fields",
    over_postings("title", "place", body="SELECT doc_id, job_id, title, company, location FROM pv WHERE job_id <> '' AND title <> '' AND company <> '' AND location <> ''"),
)
def b05(spark, sf):
    pv = postings(spark, sf, "title", "place")
    return pv.filter(medallion.critical_fields()).select("doc_id", "job_id", "title", "company", "location")


@query(
    "b06_expectations_warn",
    over_postings("title", "place", body="""SELECT rule, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed FROM (
    SELECT unnest(['job_id_not_null','title_not_null','company_not_null','location_not_null','unique_job_id','valid_location']) AS rule,
           unnest([job_id IS NOT NULL, title IS NOT NULL, company IS NOT NULL, location IS NOT NULL, job_id IS NOT NULL,
                   location IS NOT NULL AND length(location) > 2]) AS ok FROM pv) GROUP BY rule"""),
)
def b06(spark, sf):
    rules = quality.SILVER_STG_WARN | quality.SILVER_MD_WARN
    return quality.expectation_report(postings(spark, sf, "title", "place"), rules)


@query(
    "b07_expectations_drop",
    over_postings("title", body="SELECT doc_id, job_id, title FROM pv WHERE job_id <> '' AND title <> ''"),
)
def b07(spark, sf):
    return quality.keep_valid(postings(spark, sf, "title"), quality.SILVER_MD_DROP).select("doc_id", "job_id", "title")


@query(
    "b08_severity_checks",
    over_postings("title", "ingested", body="""SELECT rule, action, violations FROM (
    SELECT count(*) FILTER (job_id IS NULL) AS v1, count(*) FILTER (title IS NULL OR length(title) = 0) AS v2, count(*) FILTER (company IS NULL) AS v3,
      count(*) FILTER (NOT coalesce(CAST(ingestion_timestamp AS date) >= DATE '2024-01-31' - INTERVAL 30 DAYS, false)) AS v4, count(job_id) - count(DISTINCT job_id) AS v5 FROM pv),
    LATERAL (SELECT unnest(['job_id_not_null','title_not_empty','company_not_null','extract_date_recent','unique_job_id']) AS rule,
      unnest(['FAIL','FAIL','WARN','WARN','FAIL']) AS action, unnest([v1, v2, v3, v4, v5]) AS violations)"""),
)
def b08(spark, sf):
    pv = postings(spark, sf, "title", "ingested").withColumn("extract_date", F.to_date("ingestion_timestamp"))
    return quality.check_report(pv, quality.layer_checks("silver", EVENTS_DAY))


@query(
    "b09_location_dash",
    over_postings("place", body="""SELECT doc_id, trim(string_split(location, '-')[1]) AS city, trim(string_split(trim(string_split(location, '-')[2]), ',')[1]) AS state,
    coalesce(trim(string_split(trim(string_split(location, '-')[2]), ',')[2]), location_country) AS country FROM pv"""),
)
def b09(spark, sf):
    return spread(postings(spark, sf, "place"), "doc_id", location.parse_dash(c("location"), c("location_country")))


@query("b10_location_general", over_postings("place", body=f"SELECT doc_id, {GENERAL_PLACE_SQL} FROM pv"))
def b10(spark, sf):
    return spread(postings(spark, sf, "place"), "doc_id", location.parse_general(c("location")))


@query(
    "b10_location_by_shape",
    over_postings("place", body=f"""SELECT doc_id, trim({GENERAL_PARTS_SQL}[1]) AS city, CASE WHEN len({GENERAL_PARTS_SQL}) >= 2 THEN trim({GENERAL_PARTS_SQL}[2]) END AS state,
    coalesce(trim({GENERAL_PARTS_SQL}[3]), location_country) AS country FROM pv"""),
)
def b10_auto(spark, sf):
    return spread(postings(spark, sf, "place"), "doc_id", location.parse_auto(c("location"), c("location_country")))


@query(
    "b11_location_listing",
    over_postings("place", body="""SELECT doc_id, CASE WHEN split THEN trim(parts[1]) ELSE city0 END AS city, CASE WHEN split THEN trim(parts[2]) ELSE '' END AS state,
    CASE WHEN split AND len(parts) > 2 THEN trim(parts[-1]) ELSE 'Brazil' END AS country,
    CASE WHEN location <> '' THEN location WHEN city0 <> '' THEN city0 || ', , ' || 'BR' ELSE 'BR' END AS rebuilt FROM (
      SELECT *, coalesce(location <> '' AND city0 = '' AND len(parts) >= 2, false) AS split FROM (
        SELECT doc_id, location, string_split(location, ',') AS parts, CASE WHEN doc_id % 5 = 0 THEN lang ELSE '' END AS city0 FROM pv))"""),
)
def b11(spark, sf):
    pv = postings(spark, sf, "place").withColumn("city0", F.when(c("doc_id") % 5 == 0, c("lang")).otherwise(""))
    place = location.parse_listing(c("location"), c("city0"))
    rebuilt = location.rebuild_location(c("location"), c("city0"), F.lit(""), F.lit("BR"))
    return pv.select("doc_id", place.alias("s"), rebuilt.alias("rebuilt")).select("doc_id", "s.*", "rebuilt")


@query(
    "b12_location_state_suffix",
    over_postings("place", body="SELECT doc_id, regexp_replace(location, ', [A-Z]{2}$', '') AS city, nullif(regexp_extract(location, ', ([A-Z]{2})$', 1), '') AS state FROM pv"),
)
def b12(spark, sf):
    place = location.parse_state_suffix(c("location"))
    return spread(postings(spark, sf, "place"), "doc_id", place).drop("country")


@query(
    "b13_has_salary_info",
    over_postings("salary", body="""SELECT doc_id, coalesce(has_salary, salary_low IS NOT NULL OR salary_high IS NOT NULL) AS stated,
    coalesce(has_salary, false) OR salary_low IS NOT NULL OR salary_high IS NOT NULL AS widened, salary_low IS NOT NULL OR salary_high IS NOT NULL OR type IS NOT NULL AS payload FROM pv"""),
)
def b13(spark, sf):
    flag = lambda widen: salary.has_salary_info(c("has_salary"), c("salary_low"), c("salary_high"), widen)
    return postings(spark, sf, "salary").select(
        "doc_id", flag(False).alias("stated"), flag(True).alias("widened"),
        salary.payload_has_salary(c("salary_low"), c("salary_high"), c("type")).alias("payload"),
    )


@query(
    "b14_salary_spread",
    "SELECT l_orderkey, l_linenumber, l_extendedprice - CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS spread FROM lineitem",
)
def b14(spark, sf):
    low = F.when(c("l_discount") != 0, c("l_discount"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", salary.salary_spread(low, c("l_extendedprice")).alias("spread")
    )


SALARY_TEXT = (
    "CASE c_custkey % 4 WHEN 0 THEN 'a combinar' WHEN 1 THEN 'R$ ' || (1000 + c_custkey) ELSE "
    "'R$ ' || (1 + c_custkey % 9) || ',000 - R$ ' || (10 + c_custkey % 7) || ',500' END"
)


@query(
    "b15_salary_from_text",
    rf"""SELECT c_custkey, try_cast(replace(regexp_extract(raw, 'R\$ ([0-9,]+)', 1), ',', '') AS double) AS low,
    try_cast(replace(regexp_extract(raw, '- R\$ ([0-9,]+)', 1), ',', '') AS double) AS high FROM (SELECT c_custkey, {SALARY_TEXT} AS raw FROM customer)""",
)
def b15(spark, sf):
    return spread(table(spark, sf, "customer"), "c_custkey", salary.bounds_from_text(F.expr(SALARY_TEXT)))


@query(
    "b16_description_quality",
    """SELECT doc_id, CASE WHEN n_chars > 500 THEN 'high' WHEN n_chars > 200 THEN 'medium' ELSE 'low' END AS band,
    CASE WHEN text <> '' THEN 'high' ELSE 'low' END AS payload_band FROM documents""",
)
def b16(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.description_quality(c("n_chars")).alias("band"), text.payload_quality(c("text")).alias("payload_band")
    )


@query(
    "b17_recent_flag",
    f"""SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS date), DATE '{ORDERS_DAY}') <= 30 AS recent,
    date_diff('day', CAST(o_orderdate AS date), DATE '2001-07-15') BETWEEN 0 AND 30 AS recent_bounded,
    date_diff('day', CAST(o_orderdate AS date), DATE '{ORDERS_DAY}') < 7 AS recent_listing FROM orders""",
)
def b17(spark, sf):
    day = c("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.is_recent(day, ORDERS_DAY).alias("recent"),
        dates.is_recent(day, "2001-07-15", allow_future=False).alias("recent_bounded"),
        dates.is_recent_listing(day, ORDERS_DAY).alias("recent_listing"),
    )


@query("b18_premium_salary", "SELECT c_custkey, coalesce(c_acctbal > 8000, false) AS premium FROM customer")
def b18(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", salary.is_premium(c("c_acctbal")).alias("premium"))


@query(
    "b19_location_tier",
    """SELECT c_custkey, CASE WHEN n_name IN ('NATION_1','NATION_2','NATION_3') THEN 'tier_1' WHEN n_name IN ('NATION_4','NATION_5') THEN 'tier_2' ELSE 'tier_3' END AS tier
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def b19(spark, sf):
    tier = location.location_tier(c("n_name"), CORPUS_TIER_1, CORPUS_TIER_2)
    return customers_with_city(spark, sf).select("c_custkey", tier.alias("tier"))


def customers_with_city(spark, sf):
    nation = table(spark, sf, "nation")
    return table(spark, sf, "customer").join(nation, c("n_nationkey") == c("c_nationkey"), "left")


@query(
    "b20_seniority",
    over_postings("title", body=f"""SELECT doc_id, {SENIORITY_SQL} AS level,
    CASE WHEN regexp_matches(lower(title), 'principal|architect|head|director') THEN 'Principal' WHEN regexp_matches(lower(title), 'senior|sr\\.|iii|lead') THEN 'Senior'
      WHEN regexp_matches(lower(title), 'pleno|mid|ii') THEN 'Pleno' WHEN regexp_matches(lower(title), 'junior|jr\\.|trainee|entry') THEN 'Junior' ELSE 'Pleno' END AS level_substring FROM pv"""),
)
def b20(spark, sf):
    return postings(spark, sf, "title").select(
        "doc_id", classify.seniority(c("title")).alias("level"),
        classify.seniority_substring(c("title")).alias("level_substring"),
    )


@query(
    "b21_seniority_legacy",
    over_postings("title", body="""SELECT doc_id, CASE WHEN contains(title, 'Sênior') OR contains(title, 'Senior') THEN 'Senior' WHEN contains(title, 'Pleno') THEN 'Pleno'
    WHEN contains(title, 'Junior') OR contains(title, 'Jr') THEN 'Junior' ELSE 'Não especificado' END AS level FROM pv"""),
)
def b21(spark, sf):
    return postings(spark, sf, "title").select("doc_id", classify.seniority_legacy(c("title")).alias("level"))


@query(
    "b22_contract_type",
    over_postings("title", body="""SELECT doc_id, CASE WHEN regexp_matches(lower(title), 'estagiário|estágio|intern') THEN 'Estágio' WHEN regexp_matches(lower(title), 'junior|júnior|trainee') THEN 'Júnior'
    WHEN regexp_matches(lower(title), 'senior|sênior|sr\\.') THEN 'Sênior' WHEN regexp_matches(lower(title), 'pleno|mid') THEN 'Pleno'
    WHEN regexp_matches(lower(title), 'freelanc|freela') THEN 'Freelance' ELSE 'N/A' END AS contract FROM pv"""),
)
def b22(spark, sf):
    return postings(spark, sf, "title").select("doc_id", classify.contract_type(c("title")).alias("contract"))


@query("b23_job_type", over_postings(body=f"SELECT doc_id, {JOB_TYPE_SQL} AS job_type FROM pv"))
def b23(spark, sf):
    return postings(spark, sf).select("doc_id", classify.job_type(c("type")).alias("job_type"))


@query(
    "b24_company_name",
    over_postings(body=f"SELECT doc_id, {COMPANY_SQL} AS company_normalized, trim(regexp_replace(company, '(?i)(ltda|lt|sa|s\\.a|inc|corp|corporation)$', '')) AS company_loose FROM pv"),
)
def b24(spark, sf):
    return postings(spark, sf).select(
        "doc_id", classify.company_name(c("company")).alias("company_normalized"),
        classify.company_name(c("company"), whole_word=False).alias("company_loose"),
    )


@query(
    "b25_tech_stack",
    over_postings(body=f"SELECT doc_id, array_to_string({TECH_STACK_SQL}, ',') AS stack, array_to_string(list_filter({KEYWORDS_SQL}, lambda k: contains(lower(description), k)), ',') AS loose FROM pv"),
)
def b25(spark, sf):
    joined = lambda whole: F.array_join(
        classify.tech_stack(c("description"), CORPUS_KEYWORDS, whole), ","
    )
    return postings(spark, sf).select("doc_id", joined(True).alias("stack"), joined(False).alias("loose"))


# A posting's skills: up to three neighbours of the keyword list, none for every sixth posting.
SKILLS = "CASE WHEN doc_id % 6 = 5 THEN NULL ELSE slice(array({}), CAST(doc_id % 17 + 1 AS int), CAST(doc_id % 4 AS int)) END".format(
    ", ".join(f"'{k}'" for k in vocab.TECH_KEYWORDS)
)
SKILLS_SQL = "CASE WHEN doc_id % 6 = 5 THEN NULL ELSE list_slice([{}], doc_id % 17 + 1, doc_id % 17 + doc_id % 4) END".format(
    ", ".join(f"'{k}'" for k in vocab.TECH_KEYWORDS)
)


@query("b26_main_technology", over_postings(body=f"SELECT doc_id, coalesce(({SKILLS_SQL})[1], 'N/A') AS main_technology FROM pv"))
def b26(spark, sf):
    pv = postings(spark, sf).withColumn("skills", F.expr(SKILLS))
    return pv.select("doc_id", classify.main_technology(c("skills")).alias("main_technology"))


@query(
    "b27_work_modality",
    over_postings("title", "place", body="""SELECT doc_id, CASE WHEN contains(t, 'remot') OR contains(t, 'home office') THEN 'Remoto' WHEN contains(t, 'híbrid') OR contains(t, 'hybrid') THEN 'Híbrido'
    WHEN contains(t, 'presencial') OR contains(t, 'on-site') THEN 'Presencial' ELSE 'N/A' END AS modality FROM (SELECT doc_id, lower(concat_ws(' ', title, company, location, description)) AS t FROM pv)"""),
)
def b27(spark, sf):
    modality = classify.work_modality(c("title"), c("company"), c("location"), c("description"))
    return postings(spark, sf, "title", "place").select("doc_id", modality.alias("modality"))


@query(
    "b28_listing_modality",
    over_postings("place", body="""SELECT doc_id, CASE WHEN contains(lower(location), 'remote') THEN 'remote' WHEN contains(lower(location), 'hybrid') THEN 'hybrid' WHEN location <> '' THEN 'onsite' END AS modality,
    coalesce(contains(lower(location), 'remote'), false) AS is_remote FROM pv"""),
)
def b28(spark, sf):
    modality = classify.listing_modality(c("location"))
    return postings(spark, sf, "place").select(
        "doc_id", modality.alias("modality"), F.coalesce(modality == "remote", F.lit(False)).alias("is_remote")
    )


RELATIVE = (
    "CASE doc_id % 8 WHEN 0 THEN (doc_id % 29) || ' days ago' WHEN 1 THEN 'há ' || (doc_id % 5) || ' semanas' "
    "WHEN 2 THEN (doc_id % 24) || ' hours ago' WHEN 3 THEN 'a day ago' WHEN 4 THEN 'há ' || (doc_id % 13) || ' dias' "
    "WHEN 5 THEN 'a week ago' WHEN 6 THEN 'agora' END"
)


@query(
    "b29_relative_date",
    f"""SELECT doc_id, CAST(DATE '{POSTINGS_DAY}' - CAST(CASE WHEN t LIKE '%hour%' OR t LIKE '%hora%' THEN 0 WHEN t LIKE '%day%' OR t LIKE '%dia%' THEN n WHEN t LIKE '%week%' OR t LIKE '%semana%' THEN n * 7 ELSE 0 END AS int) AS date) AS posted_date
    FROM (SELECT doc_id, t, CASE WHEN regexp_replace(t, '[^0-9]', '', 'g') IN ('', '0') THEN 1 ELSE CAST(regexp_replace(t, '[^0-9]', '', 'g') AS bigint) END AS n
      FROM (SELECT doc_id, lower({RELATIVE}) AS t FROM documents))""",
)
def b29(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", dates.relative_date(F.expr(RELATIVE), POSTINGS_DAY).alias("posted_date")
    )


@query(
    "b30_posting_id",
    over_postings("title", "place", body="""SELECT doc_id, 'job_' || md5(concat(coalesce(title, ''), '_', coalesce(company, ''), '_', coalesce(location, '')))[1:8] AS short_id,
    'k_' || md5(concat(coalesce(title, ''), '_', coalesce(company, ''), '_', coalesce(location, ''))) AS content_key FROM pv"""),
)
def b30(spark, sf):
    key = (c("title"), c("company"), c("location"))
    return postings(spark, sf, "title", "place").select(
        "doc_id", text.posting_id(*key, digits=8).alias("short_id"), text.posting_id(*key, "k_", 32).alias("content_key")
    )


@query(
    "b31_snippet_length",
    over_postings(body="SELECT doc_id, CASE WHEN length(description) > 200 THEN description[1:200] || '...' ELSE description END AS snippet, length(description) AS n, company <> '' AS has_company FROM pv"),
)
def b31(spark, sf):
    return postings(spark, sf).select(
        "doc_id", text.snippet(c("description")).alias("snippet"), F.length("description").alias("n"),
        text.present(c("company")).alias("has_company"),
    )


@query(
    "b32_title_relevance",
    over_postings("title", body="""SELECT doc_id, category, title FROM pv WHERE title <> '' AND CASE category WHEN 'data_engineer' THEN regexp_matches(lower(title), 'widget|bolt|gear')
    WHEN 'data_analytics' THEN regexp_matches(lower(title), 'ring|plate') ELSE true END"""),
)
def b32(spark, sf):
    relevant = text.title_relevant(c("title"), c("category"), CORPUS_TERMS)
    return postings(spark, sf, "title").filter(relevant).select("doc_id", "category", "title")


@query(
    "b33_search_relevance",
    """SELECT conv_id, turn, len(list_filter(['the','of','und','les'], lambda w: contains(lower(text), w))) >= 2 AS relevant FROM conversations""",
)
def b33(spark, sf):
    rule = text.search_relevant(c("text"), F.lit("the of  und LES"))
    return table(spark, sf, "conversations").select("conv_id", "turn", rule.alias("relevant"))


@query(
    "b34_required_fields",
    over_postings("title", body="SELECT doc_id, coalesce(title <> '' AND company <> '', false) AS scraped_ok, coalesce(title <> '', false) OR coalesce(url <> '', false) AS payload_ok FROM pv"),
)
def b34(spark, sf):
    ok = lambda name: text.present(c(name))
    return postings(spark, sf, "title").select(
        "doc_id", (ok("title") & ok("company")).alias("scraped_ok"), (ok("title") | ok("url")).alias("payload_ok")
    )


@query(
    "b35_stream_gate",
    "SELECT event_id, event_type AS category FROM events WHERE event_type IN ('click','view','signup') AND ts IS NOT NULL AND props IS NOT NULL AND CAST(ts AS date) = DATE '2024-01-15'",
)
def b35(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", c("event_type").alias("category"), c("ts").alias("extract_timestamp"), c("props").alias("title"),
        c("user_id").alias("company"), F.to_date("ts").alias("extract_date"),
    )
    return stream_gate(rows, "2024-01-15", ["click", "view", "signup"]).select("event_id", "category")


@query(
    "b36_alert_payload",
    over_postings("title", body="""SELECT doc_id, 'NEW_JOB' AS alert_type, category, '🚨 Nova vaga detectada: ' || coalesce(title, 'N/A') || ' - ' || coalesce(company, 'N/A') AS message,
    CASE WHEN regexp_matches(lower(title), 'senior|sênior|lead') THEN 'HIGH' ELSE 'MEDIUM' END AS priority, job_id FROM pv"""),
)
def b36(spark, sf):
    alert = messages.alert_payload(
        c("category"), c("title"), c("company"), F.struct("job_id", "title"), F.lit(POSTINGS_DAY).cast("timestamp")
    )
    schema = "alert_type string, category string, message string, priority string, job_data struct<job_id: string>"
    read = postings(spark, sf, "title").select("doc_id", F.from_json(alert, schema).alias("a"))
    return read.select("doc_id", "a.alert_type", "a.category", "a.message", "a.priority", c("a.job_data.job_id").alias("job_id"))


@query(
    "b37_city_pattern",
    """SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE lower(n_name) LIKE '%\\_1%' ESCAPE '\\' OR lower(n_name) LIKE '%\\_20%' ESCAPE '\\' OR lower(n_name) LIKE '%\\_3%' ESCAPE '\\'""".replace("\\\\", "\\"),
)
def b37(spark, sf):
    rule = location.city_matches(c("n_name"), CORPUS_CITY_PARTS)
    return customers_with_city(spark, sf).filter(rule).select("c_custkey", "n_name")


@query(
    "b38_city_exact",
    "SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE lower(n_name) IN ('nation_1','nation_7','nation_12')",
)
def b38(spark, sf):
    return customers_with_city(spark, sf).filter(location.city_in(c("n_name"), CORPUS_CITIES)).select("c_custkey", "n_name")


@query(
    "b39_effective_time",
    over_postings("posted", "ingested", body="SELECT doc_id, coalesce(posted_time_ts, ingestion_timestamp) AS effective_posted_time FROM pv"),
)
def b39(spark, sf):
    when = dates.effective_time(c("posted_time_ts"), c("ingestion_timestamp"))
    return postings(spark, sf, "posted", "ingested").select("doc_id", when.alias("effective_posted_time"))


REPLY = (
    "CASE doc_id % 6 WHEN 0 THEN 'sim job_' || doc_id WHEN 1 THEN '  NAO   job_' || doc_id || ' ' "
    "WHEN 2 THEN 'talvez job_' || doc_id WHEN 3 THEN 'SIM' WHEN 4 THEN 'Sim Job_' || doc_id || ' obrigado' END"
)
REPLY_SQL = f"""reply AS (SELECT doc_id, coalesce(len(w) >= 2 AND upper(w[1]) IN ('SIM', 'NAO'), false) AS valid, w FROM (
    SELECT doc_id, list_filter(regexp_split_to_array(trim({REPLY}), '[ \\t]+'), lambda x: x <> '') AS w FROM documents))"""


@query(
    "b40_reply_parse",
    f"WITH {REPLY_SQL} SELECT doc_id, valid, CASE WHEN valid THEN upper(w[1]) END AS decision, CASE WHEN valid THEN w[2] END AS job_id FROM reply",
)
def b40(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id", messages.parse_reply(F.expr(REPLY)))


@query(
    "b41_notification_text",
    """SELECT o_orderkey, '*Nova vaga disponível!*' || chr(10) || 'ID: `job_' || o_orderkey || '`' || chr(10) || 'Título: ' || o_orderpriority || chr(10) || 'Empresa: ' || o_orderstatus || chr(10) ||
    'Modalidade: N/A' || chr(10) || 'Publicada em: ' || strftime(o_orderdate, '%d/%m/%Y') || chr(10) || '[Abrir vaga](https://jobs.example.com/' || o_orderkey || ')' || chr(10) || chr(10) ||
    'Você se candidatou? Responda aqui com:' || chr(10) || 'SIM job_' || o_orderkey || ' ou NAO job_' || o_orderkey || '.' AS message FROM orders""",
)
def b41(spark, sf):
    job_id = F.concat(F.lit("job_"), c("o_orderkey").cast("string"))
    url = F.concat(F.lit("https://jobs.example.com/"), c("o_orderkey").cast("string"))
    message = messages.notification_text(
        job_id, c("o_orderpriority"), c("o_orderstatus"), F.lit("N/A"), c("o_orderdate"), url
    )
    return table(spark, sf, "orders").select("o_orderkey", message.alias("message"))


def run_table(spark, sf):
    """Events as runs of one job per user."""
    e = table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("run_"), c("user_id").cast("string")).alias("job_name"), c("event_id").alias("run_id"),
        F.unix_millis(c("ts").cast("timestamp")).alias("start_time"),
        F.when(c("event_type") == "view", "RUNNING").otherwise("TERMINATED").alias("life_cycle_state"),
        F.when(c("event_type") == "error", "FAILED").when(~c("event_type").isin("view", "signup"), "SUCCESS").alias("result_state"),
    )


RUNS_SQL = """runs AS (SELECT 'run_' || user_id AS job_name, event_id AS run_id, epoch_ms(ts) AS start_time,
    CASE WHEN event_type = 'view' THEN 'RUNNING' ELSE 'TERMINATED' END AS life_cycle_state,
    CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type NOT IN ('view', 'signup') THEN 'SUCCESS' END AS result_state FROM events),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY start_time DESC, run_id DESC) AS position FROM runs)"""


@query(
    "b42_run_health",
    f"""WITH {RUNS_SQL}, last AS (SELECT job_name, max(start_time) FILTER (position = 1) AS st, max(life_cycle_state) FILTER (position = 1) AS lc, max(result_state) FILTER (position = 1) AS rs,
      100.0 * count(*) FILTER (result_state = 'SUCCESS') / count(*) AS success_rate FROM ranked WHERE position <= 5 GROUP BY job_name),
    s AS (SELECT 'run_' || c_custkey AS job_name, success_rate, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'NOT_FOUND' WHEN st IS NULL THEN 'NO_RUNS'
      WHEN rs = 'SUCCESS' AND (epoch_ms(TIMESTAMP '{EVENTS_DAY} 12:00:00') - st) / 3600000.0 > 24 THEN 'STALE' WHEN rs = 'SUCCESS' THEN 'HEALTHY' WHEN rs = 'FAILED' THEN 'FAILED'
      WHEN lc = 'RUNNING' THEN 'RUNNING' ELSE 'UNKNOWN' END AS status FROM customer LEFT JOIN last ON last.job_name = 'run_' || c_custkey)
    SELECT job_name, status, CASE WHEN status IN ('NOT_FOUND','FAILED') THEN 'ERROR' WHEN status IN ('NO_RUNS','STALE','UNKNOWN') THEN 'WARNING' ELSE 'INFO' END AS severity, success_rate FROM s""",
)
def b42(spark, sf):
    expected = table(spark, sf, "customer").select(
        "c_mktsegment", F.concat(F.lit("run_"), c("c_custkey").cast("string")).alias("job_name")
    )
    known = expected.filter(c("c_mktsegment") != "FURNITURE").select("job_name")
    return monitoring.run_health(expected.select("job_name"), known, run_table(spark, sf), f"{EVENTS_DAY} 12:00:00")


ERROR_TEXT = (
    "CASE event_id % 5 WHEN 0 THEN 'QUOTA_EXCEEDED for job ' || event_id WHEN 1 THEN 'Volume raw not found' "
    "WHEN 2 THEN 'DATASET_NOT_DEFINED: jobs' WHEN 3 THEN 'Volume full' ELSE 'timeout' END"
)


@query(
    "b43_error_events",
    f"""SELECT event_id, message, CASE WHEN message LIKE '%QUOTA_EXCEEDED%' THEN 'sequential_execution' WHEN message LIKE '%Volume%' AND message LIKE '%not found%' THEN 'recreate_volumes'
    WHEN message LIKE '%DATASET_NOT_DEFINED%' THEN 'refresh_schema' END AS recommendation FROM (SELECT event_id, {ERROR_TEXT} AS message FROM events WHERE event_type = 'error')""",
)
def b43(spark, sf):
    log = table(spark, sf, "events").select("event_id", F.upper("event_type").alias("level"), F.expr(ERROR_TEXT).alias("message"))
    return monitoring.error_events(log).select("event_id", "message", "recommendation")


@query(
    "b44_audit_columns",
    f"SELECT doc_id, TIMESTAMP '{POSTINGS_DAY} 00:00:00' AS processed_at, 1.0::double AS bronze_quality_score, 'data_engineer' AS domain FROM documents",
)
def b44(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return jobs.audit_columns(d, "bronze", "data_engineer", F.lit(POSTINGS_DAY).cast("timestamp"))


@query(
    "b45_field_aliases",
    "SELECT page_id, coalesce(CASE WHEN page_id % 3 = 0 THEN NULL ELSE url END, CASE WHEN page_id % 2 = 0 THEN 'link_' || page_id END, '') AS url FROM pages",
)
def b45(spark, sf):
    url = F.when(c("page_id") % 3 != 0, c("url"))
    link = F.when(c("page_id") % 2 == 0, F.concat(F.lit("link_"), c("page_id").cast("string")))
    return table(spark, sf, "pages").select("page_id", first_given(url, link).alias("url"))


@query("b46_batch_id", "SELECT event_id, event_type || '_' || strftime(ts, '%Y-%m-%d_%H%M%S') AS batch_id FROM events")
def b46(spark, sf):
    made = text.batch_id(c("event_type"), F.to_date("ts"), c("ts"))
    return table(spark, sf, "events").select("event_id", made.alias("batch_id"))


@query(
    "b47_posting_search",
    over_postings("title", "place", "posted", body=f"""SELECT doc_id, title, posted_time_ts FROM pv WHERE contains(lower(title), 'ring') AND posted_time_ts >= TIMESTAMP '{ORDERS_DAY}' - INTERVAL 700 DAYS
    AND NOT coalesce(contains(lower(location), 'hybrid'), false) ORDER BY posted_time_ts DESC, doc_id LIMIT 20"""),
)
def b47(spark, sf):
    pv = postings(spark, sf, "title", "place", "posted")
    not_hybrid = ~F.coalesce(F.contains(F.lower("location"), F.lit("hybrid")), F.lit(False))
    found = search_postings(
        pv, "Ring", "title", "posted_time_ts", ORDERS_DAY, "700 days", not_hybrid, 20, tiebreak="doc_id"
    )
    return found.select("doc_id", "title", "posted_time_ts")
