"""Column rules on hand-written cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobstrata.functions import classify, dates, location, messages, salary, text
from tests.helpers import values


def test_text_is_collapsed_and_lowered(spark):
    assert values(spark, text.normalize_text, ["  Data \t\n Engineer ", "", None, "ÉCLAIR"]) == [
        "data engineer", "", None, "éclair",
    ]


def test_safe_double(spark):
    assert values(spark, text.safe_double, ["R$ 8.000", "", "-", "12-3", "R$ 1500", None]) == [
        8.0, None, None, None, 1500.0, None,
    ]


def test_description_quality_bounds(spark):
    got = values(spark, text.description_quality, [501, 500, 201, 200, 0, None], "bigint")
    assert got == ["high", "medium", "medium", "low", "low", "low"]


def test_snippet(spark):
    assert values(spark, text.snippet, ["a" * 200, "a" * 201, None]) == ["a" * 200, "a" * 200 + "...", None]


def test_posting_id_depends_on_content_only(spark):
    rows = [("t", "c", "l"), ("t", "c", "l"), ("t", "c", "m"), (None, "c", "l")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    ids = [r[0] for r in df.select(text.posting_id(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert ids[0] == ids[1] and len(set(ids)) == 3
    assert all(i.startswith("job_") and len(i) == 36 for i in ids)


def test_search_relevance_needs_half_of_the_words(spark):
    rule = lambda title: values(spark, lambda c: text.search_relevant(c, F.lit("senior data engineer python")), [title])[0]
    assert rule("Data Engineer") is True
    assert rule("Engineer") is False
    assert values(spark, lambda c: text.search_relevant(c, F.lit("data")), ["Big DATA", "ops", None]) == [True, False, False]
    assert values(spark, lambda c: text.search_relevant(c, F.lit("  ")), ["anything"]) == [False]


def test_title_relevance(spark):
    rows = [
        ("Engenheiro de Dados", "data_engineer", True), ("Chef", "data_engineer", False), ("", "data_engineer", False),
        (None, "other", False), ("Chef", "other", True), ("Web Analista", "digital_analytics", True),
        ("BI Lead", "data_analytics", True),
    ]
    df = spark.createDataFrame(rows, "t string, c string, want boolean")
    assert df.filter(text.title_relevant(F.col("t"), F.col("c")) != F.col("want")).count() == 0


@pytest.mark.parametrize(
    "path,want",
    [
        ("/v/2025-09-03/jobs/data_engineer_20250903.jsonl", "2025-09-03"),
        ("/v/jobs/data_engineer_2025-09-04.json", "2025-09-04"),
        ("/v/jobs/data_engineer_20250905.jsonl", "2025-09-05"),
        ("/v/jobs/data_engineer.json", None),
        ("/v/jobs/id_123456789.json", None),
    ],
)
def test_extract_date(spark, path, want):
    rule = lambda c: dates.path_extract_date(c, F.substring_index(c, "/", -1))
    assert values(spark, rule, [path]) == [want]


def test_relative_dates(spark):
    cases = {
        "3 days ago": "2025-10-03", "há 2 semanas": "2025-09-22", "5 hours ago": "2025-10-06", "a day ago": "2025-10-05",
        "0 dias": "2025-10-05", "now": "2025-10-06", "99999999999999999999 days": "2025-10-06", "900000 weeks": "2025-10-06",
        "9000000000000000000 weeks": "2025-10-06", "739000 days": "0002-06-14",
    }
    got = values(spark, lambda c: dates.relative_date(c, "2025-10-06"), list(cases))
    assert [str(d) for d in got] == list(cases.values())


def test_bad_timestamps_become_null(spark):
    assert values(spark, dates.parse_timestamp, ["2025-09-02T23:39:18.778348", "soon", "", None]) == [
        dt.datetime(2025, 9, 2, 23, 39, 18, 778348), None, None, None,
    ]


def test_recency(spark):
    days = ["2025-09-06", "2025-09-05", "2025-12-01", None]
    rule = lambda c: dates.is_recent(c.cast("timestamp"), "2025-10-06")
    assert values(spark, rule, days) == [True, False, True, None]
    bounded = lambda c: dates.is_recent(c.cast("timestamp"), "2025-10-06", allow_future=False)
    assert values(spark, bounded, days) == [True, False, False, None]


def test_salary_text(spark):
    got = values(spark, salary.bounds_from_text, ["R$ 1,000 - R$ 2,000", "R$ 900", "a combinar", None])
    assert [tuple(r) for r in got] == [(1000.0, 2000.0), (900.0, None), (None, None), (None, None)]


def test_stated_flag_hides_values_unless_widened(spark):
    df = spark.createDataFrame([(False, 1.0), (None, 1.0), (None, None), (True, None)], "f boolean, lo double")
    low, high = F.col("lo"), F.lit(None).cast("double")
    stated = [r[0] for r in df.select(salary.has_salary_info(F.col("f"), low, high)).collect()]
    widened = [r[0] for r in df.select(salary.has_salary_info(F.col("f"), low, high, True)).collect()]
    assert stated == [False, True, False, True]
    assert widened == [True, True, False, True]


def places(spark, rule, inputs):
    return [tuple(p) for p in values(spark, rule, inputs)]


def test_location_forms(spark):
    assert places(spark, lambda c: location.parse_dash(c, F.lit("br")), ["são paulo - sp, brasil", "recife", "recife - pe"]) == [
        ("são paulo", "sp", "brasil"), ("recife", None, "br"), ("recife", "pe", "br"),
    ]
    assert places(spark, location.parse_general, ["São Paulo - SP, Chile", "Recife, PE", "Recife", None]) == [
        ("São Paulo", "SP", "Chile"), ("Recife", "PE", "Brasil"), ("Recife", None, "Brasil"), (None, None, "Brasil"),
    ]
    assert places(spark, location.parse_listing, ["São Paulo, SP, Brazil", "São Paulo, SP", "Remote", "", None]) == [
        ("São Paulo", "SP", "Brazil"), ("São Paulo", "SP", "Brazil"), ("", "", "Brazil"), ("", "", "Brazil"), ("", "", "Brazil"),
    ]
    assert places(spark, location.parse_state_suffix, ["Recife, PE", "Recife, pe", "Recife"]) == [
        ("Recife", "PE", None), ("Recife, pe", None, None), ("Recife", None, None),
    ]
    assert places(spark, lambda c: location.parse_auto(c, F.lit("br")), ["recife, pe", "brasil", "recife - pe, brasil", "recife"]) == [
        ("recife", "pe", "br"), (None, None, "brasil"), ("recife", "pe", "brasil"), ("recife", None, "br"),
    ]


def test_tiers_and_city_patterns(spark):
    assert values(spark, location.location_tier, ["são paulo", "curitiba", "recife", None]) == [
        "tier_1", "tier_2", "tier_3", "tier_3",
    ]
    assert values(spark, location.city_matches, ["São Paulo Area", "Lisboa", None]) == [True, False, None]


def test_seniority(spark):
    titles = ["Head of Data", "Sênior", "Sr. Dev", "Leadership Coach", "Dev III", "Dev II", "Jr. Dev", "Júnior", "Dev", None]
    assert values(spark, classify.seniority, titles) == [
        "Principal", "Senior", "Senior", "Pleno", "Senior", "Pleno", "Junior", "Junior", "Pleno", "Pleno",
    ]
    assert values(spark, classify.seniority_substring, ["Leadership Coach", "Sênior"]) == ["Senior", "Pleno"]
    assert values(spark, classify.seniority_legacy, ["Sênior", "Jr Dev", "pleno", None]) == [
        "Senior", "Junior", "Não especificado", "Não especificado",
    ]


def test_contract_and_job_type(spark):
    assert values(spark, classify.contract_type, ["Estágio em Dados", "Trainee", "Sr. Dev", "Mid Dev", "Freelancer", "Dev", None]) == [
        "Estágio", "Júnior", "Sênior", "Pleno", "Freelance", "N/A", "N/A",
    ]
    assert values(spark, classify.job_type, [None, "Full-time", "Part time", "Contract", "Remote", "Hybrid", "Outro"]) == [
        "Não informado", "CLT", "Meio período", "Temporário", "Remoto", "Híbrido", "Outro",
    ]


def test_company_suffix_needs_a_separator(spark):
    names = ["acme ltda", "casa", "acme s.a", "acme, inc", "corporation", None]
    assert values(spark, classify.company_name, names) == ["acme", "casa", "acme", "acme", "corporation", None]
    assert values(spark, lambda c: classify.company_name(c, False), ["casa"]) == ["ca"]


def test_tech_stack_modes(spark):
    texts = ["Python, SQL/Spark; JavaScript and R.", "pyspark", "", None]
    assert values(spark, classify.tech_stack, texts) == [["python", "spark", "sql", "r"], ["pyspark"], [], []]
    loose = values(spark, lambda c: classify.tech_stack(c, ["java", "spark"], whole_word=False), texts)
    assert loose == [["java", "spark"], ["spark"], [], []]
    special = lambda c: classify.tech_stack(c, ["c++", "power bi", "sql"])
    assert values(spark, special, ["SQL, C++ e Power BI", "powerbi"]) == [["c++", "power bi", "sql"], []]


def test_work_modality(spark):
    assert values(spark, classify.work_modality, ["Home Office", "HÍBRIDO", "on-site", "x", None]) == [
        "Remoto", "Híbrido", "Presencial", "N/A", "N/A",
    ]
    assert values(spark, classify.listing_modality, ["Rio (remote)", "Rio (hybrid)", "Rio", "", None]) == [
        "remote", "hybrid", "onsite", None, None,
    ]


def test_replies(spark):
    got = values(spark, messages.parse_reply, ["sim Job_5 ok", " NAO  j ", "sim", "talvez j", "", None])
    assert [tuple(r) for r in got] == [
        (True, "SIM", "Job_5"), (True, "NAO", "j"), (False, None, None), (False, None, None), (False, None, None), (False, None, None),
    ]


def test_error_recommendations(spark):
    logged = ["x QUOTA_EXCEEDED y", "Volume a not found", "Volume full", "DATASET_NOT_DEFINED", None]
    assert values(spark, classify.error_recommendation, logged) == [
        "sequential_execution", "recreate_volumes", None, "refresh_schema", None,
    ]


def test_numbered_notification(spark):
    row = spark.range(1).select(
        messages.numbered_text(
            F.lit(1), F.lit(2), F.lit("data"), F.lit("Dev"), F.lit("Acme"), F.lit("Remoto"), F.lit("job_0123456789"), F.lit("u")
        )
    ).first()[0]
    assert row.startswith("*🆕 Nova Vaga 1/2*\n\n*Domínio:* data\n") and "*ID:* `job_012345...`" in row
