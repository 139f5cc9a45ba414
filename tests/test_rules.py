"""Random raw rows and random stage rules: exits by projection equal exits by window equal brute force."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stagelight.operators import load, marts, stages, star
from stagelight.schemas import RAW, Stage
from stagelight.sources.views import create_views
from stagelight.sources.warehouse import write_tables


def random_rules(rng):
    """Stages in any order of days, with ties, each passed by about half of the rows."""
    tests = [
        (lambda: F.col("score") >= 4000, lambda r: r["score"] is not None and r["score"] >= 4000),
        (lambda: F.col("python_exp") == 1, lambda r: r["python_exp"] == "Yes"),
        (lambda: F.col("location") == "Urban", lambda r: r["location"] == "Urban"),
        (lambda: F.col("offer_history") > 0, lambda r: (r["offer_history"] or 0) > 0),
        (lambda: F.col("years_experience") >= 1, lambda r: (r["experience_years"] or 0) >= 1),
        (lambda: F.lit(True), lambda r: True),
    ]
    rng.shuffle(tests)
    days = [rng.choice([0, 2, 2, 5, 9]) for _ in tests]
    rules = [Stage(f"S{i}", d, "raw", column) for i, (d, (column, _)) in enumerate(zip(days, tests, strict=True))]
    return rules, [check for _, check in tests]


def random_raw(rng, n):
    pick = rng.choice
    return [
        {
            "serial_no": i, "gender": "x", "education": "Graduate", "experience_years": pick([None, 0, 1]),
            "python_exp": pick(["Yes", "No", None]), "internship": "No", "score": pick([None, 3999, 4000]),
            "location": pick(["Urban", "Rural", None]), "salary_band": 0.0, "offer_history": pick([None, 0, 1]),
            "recruitment_status": pick(["Y", "N"]),
        }
        for i in rng.sample(range(10_000), n)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_projected_exits_equal_windowed_exits(spark, seed):
    rng = random.Random(seed)
    rules, checks = random_rules(rng)
    raw_rows = random_raw(rng, 200)
    expected, counts = Counter(), Counter()
    for row in raw_rows:
        app, applied = row["serial_no"], dt.date(2024, 1, 1) + dt.timedelta(days=row["serial_no"])
        entered = [(s.days, rank, s.name) for rank, (s, ok) in enumerate(zip(rules, checks), 1) if ok(row)]
        entered.sort()
        for i, (days, rank, name) in enumerate(entered):
            exit_days = entered[i + 1][0] if i + 1 < len(entered) else None
            exited = None if exit_days is None else applied + dt.timedelta(days=exit_days)
            expected[app * 10 + rank, app, name, applied + dt.timedelta(days=days), exited] += 1
            counts[name] += 1
    rows = load.journeys(spark.createDataFrame(raw_rows, RAW), stages=rules)
    projected = stages.closed_stage_events(rows, rules)
    events = stages.stage_events(rows, rules)
    assert Counter(map(tuple, projected.collect())) == expected
    assert Counter(map(tuple, stages.stage_events_closed(events).collect())) == expected
    funnel = [(s.name, counts[s.name]) for s in rules if counts[s.name]]
    assert [tuple(r) for r in marts.funnel_counts(rows, rules).collect()] == funnel
    assert [tuple(r) for r in marts.funnel_counts(stages.reached_stages(events, rules), rules).collect()] == funnel


def test_more_than_nine_stages(spark):
    rules = [Stage(f"S{i}", i, "raw", lambda: F.lit(True)) for i in range(12)]
    raw = spark.createDataFrame(random_raw(random.Random(5), 20), RAW)
    rows = load.journeys(raw, stages=rules)
    events = stages.stage_events(rows, rules)
    assert events.select("stage_event_id").distinct().count() == events.count() == 240
    closed = Counter(map(tuple, stages.closed_stage_events(rows, rules).collect()))
    assert closed == Counter(map(tuple, stages.stage_events_closed(events).collect()))


def test_own_stages_give_the_same_from_rows_facts_and_views(spark, tmp_path):
    rules = [
        Stage("Seen", 0, "applications", lambda: F.lit(True)),
        Stage("Urban", 3, "candidates", lambda: F.col("location") == "Urban"),
    ]
    raw = spark.createDataFrame(random_raw(random.Random(8), 120), RAW).withColumn("on", F.lit("2021-05-06"))
    own = {"recruiter_key": F.lit(2), "source_key": F.lit(3), "role_key": F.lit(4)}
    tables = write_tables(raw, str(tmp_path), applied_on=F.col("on"), stages=rules, assigned=own)
    rows = star.with_assigned_keys(load.journeys(raw, applied_on=F.col("on"), stages=rules), own)
    reached = marts.with_reached(tables["fact_application"], tables["fact_stage_event"], rules)
    create_views(tables, rules)

    def same(direct, stored, view):
        found = [sorted(map(tuple, df.collect())) for df in (direct, stored, spark.table(view))]
        assert found[0] == found[1] == found[2] and found[0]
        return found[0]

    dims = star.listed_dims(spark)
    slices = same(marts.funnel_by_slice(rows, dims, rules), marts.funnel_by_slice(reached, tables, rules), "v_funnel_by_slice")
    assert {r[:3] for r in slices} == {("BI Analyst", "Job Board", "Sam")} and slices[0][4] == 120
    cohorts = same(marts.cohort_conversion(rows, rules), marts.cohort_conversion(reached, rules), "v_cohort_conversion")
    assert [r[:2] for r in cohorts] == [("2021-05", 120)]
    assert spark.table("v_funnel_counts").count() == 2 and spark.table("v_conversion_overall").first()["seen"] == 120
