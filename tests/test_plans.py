"""Shape of physical plans: scans, joins, shuffles, columns read."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import golden
from stagelight import registry
from stagelight.operators import load, marts, quality, stages, star
from stagelight.schemas import CONSTRAINTS, RAW
from stagelight.sources.warehouse import read_tables, write_tables

SF_DIR = "/root/testdata/sf0.01"


def final_plan(df):
    """The plan after adaptive execution; without it, the plan as it is."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def static_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(plan, operator):
    return len(re.findall(rf"[ *)]{operator}\b", plan))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored"))
    write_tables(golden.golden_raw(spark), folder)
    return read_tables(spark, folder)


@pytest.mark.parametrize(
    "name",
    ["candidates", "applications", "stage_events", "stage_events_closed", "fact_stage_event", "applications_flat"],
)
def test_record_level_results_take_one_scan_and_no_shuffle(spark, name):
    plan = static_plan(entry_point.queries()[name](spark, SF_DIR))
    assert count(plan, "FileScan parquet") == 2
    assert count(plan, "BroadcastHashJoin") == 1
    assert count(plan, "Exchange hashpartitioning") == 0
    assert count(plan, "Window") == 0


@pytest.mark.parametrize("name", ["funnel_counts", "conversion_overall", "score_band", "conversion_by_education"])
def test_aggregates_take_one_scan_and_combine_before_the_shuffle(spark, name):
    plan = final_plan(entry_point.queries()[name](spark, SF_DIR))
    assert count(plan, "FileScan parquet") == 2
    assert "partial_" in plan
    assert count(plan, "BroadcastHashJoin") == 1


def test_scan_reads_only_needed_columns(spark):
    plan = static_plan(entry_point.queries()["conversion_by_location"](spark, SF_DIR))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    columns = {re.sub(r"#\d+L?", "", c) for scan in scans for c in scan.split(",")}
    assert columns == {"o_custkey", "o_orderstatus", "o_totalprice", "c_custkey", "c_nationkey"}


def test_stored_mart_scans_only_needed_columns(tables):
    plan = static_plan(marts.score_band(tables["fact_application"]))
    assert [re.sub(r"#\d+L?", "", s) for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)] == ["score,hired"]
    plan = static_plan(marts.stage_durations(tables["fact_stage_event"]))
    assert "IsNotNull(stage_exited_at)" in plan


def test_stored_dimensions_are_broadcast_by_size(spark, tables):
    flat = marts.applications_flat_star(tables["fact_application"], tables)
    assert count(static_plan(flat), "BroadcastHashJoin") == 7
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
        flat = marts.applications_flat_star(tables["fact_application"], tables)
        assert count(static_plan(flat), "BroadcastHashJoin") == 0
        assert flat.count() == 614
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_large_dimension_is_not_broadcast(spark):
    """200,000 long texts that compress to far less than the limit; the other dimensions stay small."""
    text = F.concat(F.lit("a text that compresses very well " * 3), F.col("id").cast("string"))
    values = {f.name: F.lit(None).cast(f.dataType) for f in RAW} | {
        "serial_no": F.col("id"),
        "education": text,
        "location": F.concat(F.lit("L"), (F.col("id") % 3).cast("string")),
        "python_exp": F.when(F.col("id") % 2 == 0, "Yes"),
        "internship": F.when(F.col("id") % 5 == 0, "Yes"),
    }
    rows = load.journeys(spark.range(0, 200_000, 1, 4).select([v.alias(name) for name, v in values.items()]))
    fact = star.fact_application(rows, star.dimensions(rows))
    plan = static_plan(fact)
    assert count(plan, "SortMergeJoin") == 1
    assert count(plan, "BroadcastHashJoin") == 3
    assert tuple(fact.agg(F.max("education_key"), F.countDistinct("education_key")).first()) == (200_000, 200_000)


def test_fact_is_not_shuffled_by_its_dimensions(spark):
    plan = static_plan(entry_point.queries()["fact_application"](spark, SF_DIR))
    assert count(plan, "BroadcastHashJoin") == 5
    assert count(plan, "SortMergeJoin") == 0
    assert count(plan, "Exchange hashpartitioning") == 0


def test_facts_meet_after_one_shuffle_each(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        reached = marts.with_reached(tables["fact_application"], tables["fact_stage_event"])
        plan = static_plan(reached)
        assert count(plan, "SortMergeJoin") == 1
        assert count(plan, r"Exchange hashpartitioning\(application_id#\d+L") == 2
        assert count(plan, "Exchange") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_exits_take_one_window_of_combined_days(tables):
    plan = static_plan(stages.stage_events_closed(tables["stage_events"]))
    assert count(plan, "Window") == 1
    assert "partial_max(stage_event_id" in plan


def test_events_from_tables_shuffle_applications_once(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        raw = spark.createDataFrame([], RAW)
        plan = static_plan(stages.stage_events_from_tables(tables["applications"], tables["candidates"], raw))
        assert len(re.findall(r"FileScan parquet \[application_id", plan)) == 1
        assert count(plan, "SortMergeJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_constraints_read_every_table_once(tables):
    plan = static_plan(quality.constraint_violations(tables))
    assert count(plan, "FileScan parquet") == len(CONSTRAINTS)
    assert count(plan, "Exchange hashpartitioning") == 2


def test_no_python_runs_in_any_task(spark):
    for name, query in registry.queries().items():
        plan = static_plan(query(spark, SF_DIR))
        assert not re.search(r"Python|Pandas|Arrow", plan), name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_journeys_are_a_projection(spark):
    raw = golden.golden_raw(spark)
    plan = static_plan(star.with_assigned_keys(load.journeys(raw)))
    assert count(plan, "Join") == 0
