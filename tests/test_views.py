"""SQL over the views of a stored warehouse."""

import re

import pytest

import golden
from stagelight.schemas import TABLES
from stagelight.sources.views import create_views
from stagelight.sources.warehouse import read_tables, write_tables


@pytest.fixture(scope="module")
def names(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("views"))
    write_tables(golden.golden_raw(spark), folder)
    return create_views(read_tables(spark, folder))


def rows(spark, sql):
    return [tuple(r) for r in spark.sql(sql).collect()]


def test_published_results(spark, names):
    assert rows(spark, "select * from v_funnel_counts") == golden.FUNNEL
    assert rows(spark, "select * from v_conversion_overall") == [golden.OVERALL]
    assert rows(spark, "select * from v_stage_durations") == golden.DURATIONS
    assert rows(spark, "select * from v_stage_durations_star") == golden.DURATIONS
    assert rows(spark, "select * from v_conversion_by_edu order by 1") == golden.BY_EDUCATION
    assert rows(spark, "select * from v_conversion_by_location order by 1") == golden.BY_LOCATION


def test_every_table_and_result_is_a_view(spark, names):
    assert set(TABLES) < set(names)
    for name in names:
        assert spark.sql(f"select count(*) from {name}").collect()[0][0] > 0, name


def test_views_combine_with_other_sql(spark, names):
    sql = """select recruiter_name, sum(apps) from v_funnel_by_slice where stage_name = 'Hired'
             group by recruiter_name order by 1"""
    hired = rows(spark, sql)
    assert [name for name, _ in hired] == ["Ava", "Leo", "Rita", "Sam"]
    assert sum(n for _, n in hired) == 422
    sql = "select hired, count(*) from v_applications_flat_star where location = 'Rural' group by hired order by hired"
    assert rows(spark, sql) == [(0, 69), (1, 110)]


def test_what_sql_selects_reaches_the_scan(spark, names):
    df = spark.sql("select application_id, recruiter_name from v_applications_flat_star where hired = 1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    fact = next(s for s in re.findall(r"FileScan parquet [^\n]*", plan) if "application_id" in s)
    assert "EqualTo(hired,1)" in fact
    assert "score" not in fact and "salary_band" not in fact
