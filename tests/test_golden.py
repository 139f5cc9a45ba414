"""The published results, from raw rows, from events and from stored tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import golden
from stagelight.operators import load, marts, stages, star
from stagelight.plans.shared import scratch, written
from stagelight.sources.export import export_csv, export_results
from stagelight.sources.warehouse import read_tables, write_tables


@pytest.fixture(scope="module")
def raw(spark):
    return golden.golden_raw(spark).cache()


@pytest.fixture(scope="module")
def rows(raw):
    return load.journeys(raw)


@pytest.fixture(scope="module")
def folder(raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warehouse"))
    write_tables(raw, path)
    return path


@pytest.fixture(scope="module")
def tables(spark, folder):
    return read_tables(spark, folder)


def in_order(df):
    return [tuple(r) for r in df.collect()]


def test_counts(raw, tables):
    assert in_order(load.raw_row_count(raw)) == [(614,)]
    counts = load.base_table_counts(tables["candidates"], tables["applications"])
    assert sorted(in_order(counts)) == [("applications", 614), ("candidates", 614)]
    assert tables["stage_events"].count() == 2462


def test_funnel(rows, tables):
    assert in_order(marts.funnel_counts(rows)) == golden.FUNNEL
    assert in_order(marts.funnel_counts(stages.reached_stages(tables["stage_events"]))) == golden.FUNNEL
    assert in_order(marts.stage_counts_unfiltered(tables["stage_events"])) == golden.FUNNEL


def test_overall(rows, tables):
    assert in_order(marts.conversion_overall(rows)) == [golden.OVERALL]
    assert in_order(marts.conversion_overall(stages.reached_stages(tables["stage_events"]))) == [golden.OVERALL]


def test_durations(rows, tables):
    assert in_order(marts.stage_durations(stages.closed_stage_events(rows))) == golden.DURATIONS
    assert in_order(marts.stage_durations(tables["stage_events"])) == golden.DURATIONS
    assert in_order(marts.stage_durations(tables["fact_stage_event"])) == golden.DURATIONS
    windowed = stages.stage_events_closed(stages.stage_events(rows))
    assert in_order(marts.stage_durations(windowed)) == golden.DURATIONS


def test_conversions(rows, tables):
    base = tables["applications"], tables["candidates"]
    assert sorted(in_order(marts.conversion_by_education(rows))) == golden.BY_EDUCATION
    assert sorted(in_order(marts.conversion_by_education_from_tables(*base))) == golden.BY_EDUCATION
    assert sorted(in_order(marts.conversion_by_location(rows))) == golden.BY_LOCATION
    assert sorted(in_order(marts.conversion_by_location_from_tables(*base))) == golden.BY_LOCATION


def test_events_agree(raw, rows, tables):
    def events(df):
        return sorted(in_order(df.select("stage_event_id", "application_id", "stage_name", "stage_entered_at")))

    expected = events(stages.stage_events(rows))
    assert len(expected) == 2462
    assert events(stages.stage_events_from_tables(tables["applications"], tables["candidates"], raw)) == expected
    assert events(tables["stage_events"]) == expected
    assert sorted(r.stage_event_id for r in stages.stage_events_closed(stages.stage_events(rows)).collect()) == [
        e[0] for e in expected
    ]


def test_star_marts_agree_with_journeys(spark, rows, tables):
    reached = marts.with_reached(tables["fact_application"], tables["fact_stage_event"])
    keyed, dims = star.with_assigned_keys(rows), star.listed_dims(spark)
    slices = sorted(in_order(marts.funnel_by_slice(reached, tables)))
    assert slices == sorted(in_order(marts.funnel_by_slice(keyed, dims)))
    assert sum(r[4] for r in slices if r[3] == "Applied") == 614
    assert len(slices) == 20
    cohorts = in_order(marts.cohort_conversion(reached))
    assert cohorts == in_order(marts.cohort_conversion(keyed))
    assert [c[0] for c in cohorts] == sorted(c[0] for c in cohorts)
    assert sum(c[1] for c in cohorts) == 614
    assert in_order(marts.score_band(tables["fact_application"])) == in_order(marts.score_band(rows))
    assert [r.score_band for r in marts.score_band(rows).collect()] == ["Low", "Medium"]
    flat = marts.applications_flat_star(tables["fact_application"], tables)
    assert flat.columns == marts.FLAT_STAR_COLUMNS
    assert sorted(in_order(flat.groupBy("education_level").count())) == [("Graduate", 480), ("Not Graduate", 134)]
    assert flat.where("python_exp is null or internship is null or role_name is null").count() == 0


def test_second_load_changes_nothing(raw, folder, tables):
    def snapshot():
        found = read_tables(raw.sparkSession, folder)
        return {name: sorted(map(repr, df.collect())) for name, df in found.items()}

    before = snapshot()
    write_tables(raw, folder)
    assert snapshot() == before
    assert len(before["fact_application"]) == 614
    assert before["candidates"] == sorted(map(repr, load.candidates(raw).collect()))
    assert before["applications"] == sorted(map(repr, load.applications(raw).collect()))
    assert len(before["dim_time"]) == 614


@pytest.mark.parametrize("serial_no", [7, None])
def test_load_stops_at_a_broken_key(spark, raw, tmp_path, serial_no):
    broken = raw.unionByName(raw.limit(1).withColumn("serial_no", F.lit(serial_no).cast("long")))
    with pytest.raises(ValueError, match="1 of 615"):
        write_tables(broken, str(tmp_path / "broken"))
    assert not any((tmp_path / "broken").glob("load-*"))


def test_a_refused_load_leaves_the_last_one(spark, raw, tmp_path):
    folder = str(tmp_path / "stored")

    def snapshot():
        return {name: sorted(map(repr, df.collect())) for name, df in read_tables(spark, folder).items()}

    write_tables(raw.where("serial_no <= 10"), folder)
    first = snapshot()
    few = raw.where("serial_no <= 3")
    for broken, options in [
        (few.unionByName(few.limit(1)), {}),
        (few.withColumn("on", F.when(F.col("serial_no") > 1, "2024-01-01")), {"applied_on": F.col("on")}),
    ]:
        with pytest.raises(ValueError):
            write_tables(broken, folder, **options)
        assert snapshot() == first
        assert len(list((tmp_path / "stored").glob("load-*"))) == 1
    for _ in range(3):
        write_tables(few, folder)
    assert len(snapshot()["applications"]) == 3
    assert len(list((tmp_path / "stored").glob("load-*"))) == 2  # the last one and the one before


def test_a_load_leaves_nothing_in_the_shared_folder(spark, raw, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.glob("*")}
    with scratch(spark):
        write_tables(written(raw, "raw"), str(tmp_path / "stored"))
    assert {p.name for p in shared.glob("*")} == before


def test_large_and_small_doubles_are_exported_in_fixed_notation(spark, tmp_path):
    values = [12345678.0, 123456789012.0, 12345678.25, 7.0, 0.5, 1e7, -98765432.1, 0.00012, 1200.0, 0.0, 100.50]
    spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").coalesce(1).write.parquet(str(tmp_path / "v"))
    export_csv(spark.read.parquet(str(tmp_path / "v")).orderBy("k").select("v"), str(tmp_path / "v.csv"))
    expected = ["12345678", "123456789012", "12345678.25", "7", "0.5", "10000000", "-98765432.1", "0.00012", "1200", "0", "100.5"]
    assert lines(tmp_path / "v.csv") == expected


def lines(path):
    return [line for part in sorted(Path(path).glob("part-*")) for line in part.read_text().splitlines()]


def exports(rows):
    return {
        "funnel": marts.funnel_counts(rows),
        "durations": marts.stage_durations(stages.closed_stage_events(rows)),
        "education": marts.conversion_by_education(rows).orderBy("education_level"),
        "location": marts.conversion_by_location(rows).orderBy("location"),
    }


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_exports(spark, rows, tmp_path, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        export_results(exports(rows), str(tmp_path))
        export_results(exports(rows), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert lines(tmp_path / "funnel.csv") == [f"{s},{n}" for s, n in golden.FUNNEL]
    assert lines(tmp_path / "durations.csv") == ["Screened,8.22", "Interviewed,7.51", "Offered,7", "Applied,1.99"]
    assert lines(tmp_path / "education.csv") == [",".join(map(str, r)) for r in golden.BY_EDUCATION]
    assert lines(tmp_path / "location.csv") == [",".join(map(str, r)) for r in golden.BY_LOCATION]
    if adaptive == "true":
        assert all(len(list(path.glob("part-*"))) == 1 for path in tmp_path.glob("*.csv"))


def test_export_of_many_rows_stays_in_parts(rows, tmp_path):
    export_csv(marts.applications_flat(rows).repartition(4), str(tmp_path / "flat.csv"))
    assert len(list((tmp_path / "flat.csv").glob("part-*"))) == 4
    assert len(lines(tmp_path / "flat.csv")) == 614
