"""Results with one key that holds a third of the rows, against brute force."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stagelight.operators import load, marts, stages
from stagelight.plans.keys import numbered
from stagelight.schemas import RAW, STAGE_NAMES, TABLES

DAY = dt.date(2024, 1, 1)


def random_events(seed, n=900, apps=40, days=6):
    """Events with ties, NULL dates, NULL applications, and a third of the rows in application 7."""
    rng = random.Random(seed)
    rows = []
    for event_id in rng.sample(range(10 * n), n):
        app = 7 if rng.random() < 0.34 else rng.choice([None, *range(apps)])
        day = None if rng.random() < 0.1 else DAY + dt.timedelta(days=rng.randrange(days))
        rows.append((event_id, app, rng.choice([*STAGE_NAMES, "Other"]), day, None))
    return rows


def closed_by_hand(rows):
    """The day's last id leaves on the next day, all copies of it; smaller ids leave the same day. NULL is smallest."""
    days = defaultdict(dict)
    order = lambda event_id: (event_id is not None, event_id or 0)
    for event_id, app, _, day, _ in rows:
        if day is not None:
            days[app][day] = max(days[app].get(day, event_id), event_id, key=order)
    closed = []
    for event_id, app, stage, day, _ in rows:
        later = [d for d in days[app] if day is not None and d > day]
        exited = None
        if day is not None:
            exited = min(later, default=None) if event_id == days[app][day] else day
        closed.append((event_id, app, stage, day, exited))
    return Counter(closed)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("kind", ["unique", "copies", "no ids"])
def test_exits_with_a_hot_application(spark, seed, kind):
    rows = random_events(seed)
    if kind == "copies":
        rows += random.Random(seed).choices(rows, k=300)
    if kind == "no ids":
        rows = [(None if r[0] % 3 else r[0], *r[1:]) for r in rows]
    events = spark.createDataFrame(rows, TABLES["stage_events"]).repartition(7)
    closed = stages.stage_events_closed(events)
    assert closed.columns == TABLES["stage_events"].names
    assert Counter(map(tuple, closed.collect())) == closed_by_hand(rows)


def test_a_day_without_ids_leaves_on_the_next_day(spark):
    days = [DAY, DAY, DAY + dt.timedelta(days=8)]
    rows = [(None, 1, "Applied", day, None) for day in days]
    closed = stages.stage_events_closed(spark.createDataFrame(rows, TABLES["stage_events"])).collect()
    assert sorted((r.stage_entered_at, r.stage_exited_at or DAY) for r in closed) == [(DAY, days[2])] * 2 + [(days[2], DAY)]


def test_a_window_holds_a_row_per_day_at_most(spark, small_skew_limits):
    """60,000 events of one application on one day are split over tasks."""
    events = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("stage_event_id"),
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("application_id"),
        F.lit("Applied").alias("stage_name"),
        F.lit(DAY).alias("stage_entered_at"),
        F.lit(None).cast("date").alias("stage_exited_at"),
    )
    closed = stages.stage_events_closed(events)
    assert closed.where("stage_exited_at is not null").count() == 39_999
    closed.collect()
    assert "skew=true" in closed._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_with_a_hot_application(spark):
    rows = random_events(5)
    events = spark.createDataFrame(rows, TABLES["stage_events"]).repartition(7)
    apps = defaultdict(set)
    for _, app, stage, _, _ in rows:
        if app is not None:
            apps[stage].add(app)
    expected = [(s, len(apps[s])) for s in STAGE_NAMES]
    assert [tuple(r) for r in marts.funnel_counts(stages.reached_stages(events)).collect()] == expected
    unfiltered = [tuple(r) for r in marts.stage_counts_unfiltered(events).collect()]
    assert unfiltered == [("Other", len(apps["Other"])), *expected]


def many_applications(spark):
    """500 candidates; candidate 3 has a third of 1500 applications."""
    rng = random.Random(11)
    raw = [
        (i, "x", rng.choice(["Graduate", "Not Graduate", None]), rng.choice([0, 1, None]), rng.choice(["Yes", "No"]),
         "No", rng.choice([3000, 5000, None]), rng.choice(["Urban", "Rural"]), 1.0, rng.choice([0, 1, None]),
         rng.choice(["Y", "N"]))
        for i in range(500)
    ]
    apps = []
    for app in range(1500):
        candidate = 3 if app % 3 == 0 else rng.randrange(520)
        apps.append((app, candidate, DAY + dt.timedelta(days=rng.randrange(90)), rng.randrange(2)))
    return raw, apps


@pytest.fixture
def small_skew_limits(spark):
    """Let adaptive execution split partitions of a few kilobytes."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_a_hot_candidate_is_split_over_tasks(spark, small_skew_limits):
    hot = F.when(F.col("id") % 3 == 0, 3).otherwise(F.col("id") % 5000)
    apps = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("application_id"),
        hot.cast("long").alias("candidate_id"),
        F.lit(DAY).alias("applied_at"),
        F.lit(0).alias("hired"),
    )
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in RAW if f.name != "serial_no"]
    raw = spark.range(0, 5000, 1, 8).select(F.col("id").alias("serial_no"), *blank)
    candidates = load.candidates(raw)
    for df, n in [
        (marts.applications_flat_from_tables(apps, candidates), 60_000),
        (stages.stage_events_from_tables(apps, candidates, raw), 60_000),
    ]:
        assert len(df.collect()) == n
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_joins_with_a_hot_candidate(spark, small_skew_limits):
    raw_rows, app_rows = many_applications(spark)
    raw = spark.createDataFrame(raw_rows, RAW)
    apps = spark.createDataFrame(app_rows, TABLES["applications"])
    candidates = load.candidates(raw)
    by_id = {r[0]: r for r in raw_rows}
    events, groups = Counter(), defaultdict(lambda: [0, 0])
    for app, candidate, day, hired in app_rows:
        events[app, "Applied", day] += 1
        if candidate not in by_id:
            continue
        _, _, education, years, python, _, score, _, _, offers, status = by_id[candidate]
        groups[education][0] += 1
        groups[education][1] += hired
        passed = {
            ("Screened", 1): education == "Graduate" or (score or 0) >= 4000,
            ("Interviewed", 7): python == "Yes" or (years or 0) >= 1,
            ("Offered", 14): (offers or 0) > 0,
            ("Hired", 21): status == "Y",
        }
        for (stage, days), yes in passed.items():
            if yes:
                events[app, stage, day + dt.timedelta(days=days)] += 1
    found = stages.stage_events_from_tables(apps, candidates, raw).collect()
    rates = marts.conversion_by_education_from_tables(apps, candidates).collect()
    flat = marts.applications_flat_from_tables(apps, candidates).count()
    assert Counter((r.application_id, r.stage_name, r.stage_entered_at) for r in found) == events
    assert len({r.stage_event_id for r in found}) == len(found)
    assert {r.education_level: [r.apps, r.hires] for r in rates} == dict(groups)
    assert flat == sum(1 for a in app_rows if a[1] in by_id)


def test_keys_number_any_amount_of_values_in_order(spark):
    values = {"a": [f"v{i:05d}" for i in range(3000)], "b": ["x"], "c": ["", "z", "é", "Z", "zz"]}
    rows = [(name, v) for name, vs in values.items() for v in vs]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "column_name string, value string").repartition(9)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = defaultdict(dict)
        for r in numbered(df).collect():
            found[r.column_name][r.key] = r.value
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for name, vs in values.items():
        expected = dict(enumerate(sorted(vs, key=lambda v: v.encode()), 1))
        assert found[name] == expected
