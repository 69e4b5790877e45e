"""Every registered query against its SQL, and the shape of every plan."""

import os
import re

import pytest

import __spark_entry__ as entry_module
from jobstrata.catalog import load
from tests.helpers import plan_of
from tools.check_oracle import compare, connect

QUERIES = load()


@pytest.fixture(scope="module")
def oracle(data_dir):
    con = connect(data_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, oracle, data_dir, name):
    outcome, rows = compare(spark, oracle, QUERIES[name], data_dir)
    assert outcome in ("ok", "rows only")
    # Not every rule finds rows on the smallest tables, but no query may lose its columns.
    assert rows >= 0


FORBIDDEN = r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups|CartesianProduct|BroadcastNestedLoopJoin"


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "bcdefgj"))
def test_plan_without_broadcast(no_broadcast, data_dir, name):
    """With all tables taken as large: no Python, no nested loops, no null-aware join."""
    plan = plan_of(QUERIES[name].run(no_broadcast, data_dir))
    assert not re.search(FORBIDDEN, plan)
    assert "isNullAware=true" not in plan


@pytest.mark.parametrize("name", ["e02_latest_per_key_day", "e03_first_seen", "e04_latest_per_id", "e05_last_runs", "f07_cap_per_source"])
def test_ranks_trim_before_the_shuffle(spark, data_dir, name):
    plan = plan_of(QUERIES[name].run(spark, data_dir))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_filters_and_columns_reach_the_scan(spark, data_dir):
    plan = plan_of(QUERIES["a17_table_filter"].run(spark, data_dir))
    assert re.search(r"PushedFilters: \[.*LessThan\(l_quantity,30.0\)", plan)
    assert "l_comment" not in plan and "l_tax" not in plan


def test_rules_show_every_branch(spark, data_dir):
    """An agreement on one branch would prove little."""
    seen = lambda name, column: {r[column] for r in QUERIES[name].run(spark, data_dir).select(column).collect()}
    assert seen("b20_seniority", "level") == {"Principal", "Senior", "Pleno", "Junior"}
    assert seen("b22_contract_type", "contract") == {"Estágio", "Júnior", "Sênior", "Pleno", "Freelance", "N/A"}
    assert seen("b23_job_type", "job_type") >= {"Não informado", "CLT", "Meio período", "Temporário", "Remoto", "Híbrido", "other"}
    assert seen("b27_work_modality", "modality") == {"Remoto", "Híbrido", "Presencial", "N/A"}
    assert seen("b28_listing_modality", "modality") == {"remote", "hybrid", "onsite", None}
    assert seen("b16_description_quality", "band") == {"high", "medium", "low"}
    assert seen("b19_location_tier", "tier") == {"tier_1", "tier_2", "tier_3"}
    assert seen("b43_error_events", "recommendation") == {"sequential_execution", "recreate_volumes", "refresh_schema", None}


def test_entry_points(spark):
    assert entry_module.queries().keys() >= entry_module.oracle_sql().keys()
    if not os.path.exists(entry_module.DATA_DIR):
        pytest.skip("no test tables")
    out = entry_module.entry(spark)
    assert out.columns == ["date", "company", "seniority_level", "jobs_count"] and out.count() == 10
