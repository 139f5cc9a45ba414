"""NULLs, empty inputs, dates, rates, types."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import golden
from stagelight.functions.dates import EPOCH, LAST_DAY, add_days, days_after, month_text, week_of_year
from stagelight.functions.rates import rate
from stagelight.operators import load, marts, quality, stages, star
from stagelight.schemas import RAW, RAW_SOURCE_NAMES, TABLES
from stagelight.sources.raw import BROKEN_LINE, cast_failures, read_raw, read_raw_text

BLANK = {name: None for name in RAW.names}


def raw_of(spark, *rows):
    return spark.createDataFrame([{**BLANK, **row} for row in rows], RAW)


def stages_of(raw):
    found = {}
    for row in stages.stage_events(load.journeys(raw)).orderBy("stage_event_id").collect():
        found.setdefault(row.application_id, []).append(row.stage_name)
    return found


def test_null_and_odd_values_fail_the_rules_they_touch(spark):
    raw = raw_of(
        spark,
        {"serial_no": 1},
        {"serial_no": 2, "education": "Graduate"},
        {"serial_no": 3, "education": "Not Graduate"},
        {"serial_no": 4, "education": "Not Graduate", "score": 4000},
        {"serial_no": 5, "score": 3999, "python_exp": "yes", "experience_years": 0},
        {"serial_no": 6, "experience_years": 1, "offer_history": 0, "recruitment_status": "y"},
        {"serial_no": 7, "python_exp": "Yes", "offer_history": 2, "recruitment_status": "Y"},
    )
    assert stages_of(raw) == {
        1: ["Applied"],
        2: ["Applied", "Screened"],
        3: ["Applied"],
        4: ["Applied", "Screened"],
        5: ["Applied"],
        6: ["Applied", "Interviewed"],
        7: ["Applied", "Interviewed", "Offered", "Hired"],
    }
    hired = {r.application_id: r.hired for r in load.applications(raw).collect()}
    assert hired == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 1}


def test_score_bands(spark):
    scores = [None, 0, 2499, 2500, 3999, 4000, 5999, 6000, 8999, 9000]
    raw = raw_of(spark, *[{"serial_no": i + 1, "score": s} for i, s in enumerate(scores)])
    bands = [(r.score_band, r.apps, r.hires, r.hire_rate) for r in marts.score_band(load.journeys(raw)).collect()]
    names = ["Very Low", "Low", "Medium", "High", "Very High"]
    assert bands == [(name, 2, 0, 0.0) for name in names]


def test_null_education_is_a_group_without_a_key(spark):
    raw = raw_of(
        spark,
        {"serial_no": 1, "education": "Graduate", "recruitment_status": "Y", "location": "Urban"},
        {"serial_no": 2, "recruitment_status": "Y"},
        {"serial_no": 3},
    )
    rows = {r.education_level: tuple(r)[1:] for r in marts.conversion_by_education(load.journeys(raw)).collect()}
    assert rows == {"Graduate": (1, 1, 1.0), None: (2, 1, 0.5)}
    dims = star.dimensions(load.candidates(raw))
    assert [tuple(r) for r in dims["dim_education"].collect()] == [(1, "Graduate")]
    fact = star.fact_application(load.journeys(raw), dims).orderBy("application_id").collect()
    assert [r.education_key for r in fact] == [1, None, None]
    assert [r.location_key for r in fact] == [1, None, None]
    assert [r.recruiter_key for r in fact] == [2, 3, 4]
    flat = marts.applications_flat_star(star.fact_application(load.journeys(raw), dims), dims)
    assert flat.count() == 3


def test_empty_input(spark):
    raw = spark.createDataFrame([], RAW)
    rows = load.journeys(raw)
    events = stages.stage_events(rows)
    closed = stages.stage_events_closed(events)
    dims = star.dimensions(load.candidates(raw))
    fact = star.fact_application(rows, dims)
    apps, cands = load.applications(raw), load.candidates(raw)
    assert load.raw_row_count(raw).collect()[0].raw_rows == 0
    for df in [
        events, closed, stages.closed_stage_events(rows), stages.stage_events_from_tables(apps, cands, raw),
        marts.funnel_counts(rows), marts.funnel_counts(stages.reached_stages(events)),
        marts.stage_counts_unfiltered(events), marts.stage_durations(closed), marts.score_band(rows),
        marts.conversion_by_education(rows), marts.conversion_by_location_from_tables(apps, cands),
        star.dim_time(apps), dims["dim_education"], fact,
        marts.cohort_conversion(marts.with_reached(fact, closed)),
        marts.funnel_by_slice(marts.with_reached(fact, closed), dims),
    ]:
        assert df.collect() == []
    assert [tuple(r) for r in marts.conversion_overall(rows).collect()] == [(None,) * 10]
    violations = quality.constraint_violations({"candidates": cands, "applications": apps}).collect()
    assert {(r.rows_checked, r.violations) for r in violations} == {(0, 0)}


def test_absent_stage_is_null_and_unknown_stage_is_ignored(spark):
    day = dt.date(2024, 1, 31)
    events = spark.createDataFrame(
        [
            (1, 1, "Applied", day, None),
            (2, 1, "Offered", day, None),
            (3, 1, "Offered", day, None),
            (4, 2, "Withdrawn", day, None),
        ],
        TABLES["stage_events"],
    )
    fact_rows = [(1, day), (2, dt.date(2024, 2, 1)), (3, day)]
    fact = spark.createDataFrame(fact_rows, "application_id long, applied_date_key date")
    cohorts = marts.cohort_conversion(marts.with_reached(fact, events)).collect()
    assert [tuple(r) for r in cohorts] == [
        ("2024-01", 1, None, None, 1, None),
        ("2024-02", None, None, None, None, None),
    ]
    reached = stages.reached_stages(events)
    assert [tuple(r) for r in marts.funnel_counts(reached).collect()] == [("Applied", 1), ("Offered", 1)]
    overall = marts.conversion_overall(reached).collect()[0]
    assert tuple(overall) == (1, None, None, 1, None, None, None, None, None, None)
    odd = spark.createDataFrame(
        [
            (5, 1, None, day, None),
            (6, 2, "Withdrawn", day, None),
            (7, None, "Hired", day, None),
            (8, 9, None, day, None),
        ],
        TABLES["stage_events"],
    )
    unfiltered = [tuple(r) for r in marts.stage_counts_unfiltered(events.unionByName(odd)).collect()]
    assert unfiltered == [(None, 2), ("Withdrawn", 1), ("Applied", 1), ("Offered", 1), ("Hired", 0)]


def test_rate_rounds_half_up_and_may_exceed_one(spark):
    pairs = [(201, 400, 0.503), (475, 429, 1.107), (1, 0, None), (None, 3, None), (0, 7, 0.0)]
    df = spark.createDataFrame([p[:2] for p in pairs], "a long, b long")
    assert [r[0] for r in df.select(rate(F.col("a"), F.col("b"))).collect()] == [p[2] for p in pairs]


def test_week_of_year_on_every_day_of_fifty_years(spark):
    first, last = dt.date(1990, 1, 1), dt.date(2040, 12, 31)
    days = spark.sql(f"select explode(sequence(date '{first}', date '{last}')) as d")
    rows = days.select("d", week_of_year(F.col("d")).alias("w")).collect()
    assert len(rows) == (last - first).days + 1
    assert all(r.w == int(r.d.strftime("%W")) for r in rows)


def test_dates_run_to_the_end_of_the_type_and_then_stop(spark):
    base = dt.date(2024, 1, 1)
    first = (base - EPOCH).days
    far = LAST_DAY - first
    offsets = [(-1,), (0,), (366,), (2_913_000,), (far,), (None,)]
    days = spark.createDataFrame(offsets, "n long").select(days_after(base, F.col("n")).alias("d"))
    numbers = [r[0] for r in days.select(F.unix_date("d")).collect()]
    assert numbers == [None, first, first + 366, first + 2_913_000, LAST_DAY, None]
    later = days.where(F.unix_date("d") < LAST_DAY).select(F.unix_date(add_days(F.col("d"), 21)))
    assert [r[0] for r in later.collect()] == [first + 21, first + 387, first + 2_913_021]
    for broken in (
        spark.createDataFrame([(far + 1,)], "n long").select(days_after(base, F.col("n"))),
        spark.createDataFrame([((1 << 63) - 1,)], "n long").select(days_after(base, F.col("n"))),
        days.where(F.unix_date("d") == LAST_DAY).select(add_days(F.col("d"), 1)),
    ):
        with pytest.raises(Exception, match="end of the calendar"):
            broken.collect()


def test_months_of_any_year(spark):
    days = [dt.date(2024, 3, 5), dt.date(999, 12, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    far = spark.range(1).select(days_after(dt.date(2024, 1, 1), F.lit(15_000_000)).alias("d"))
    found = df.unionByName(far).select(month_text(F.col("d"))).collect()
    assert [r[0] for r in found] == ["2024-03", "0999-12", None, "43092-08"]


def test_applied_on_replaces_the_day_rule(spark):
    raw = raw_of(spark, {"serial_no": 1}).withColumn("seen", F.lit("2020-02-29"))
    assert load.applications(raw, applied_on=F.col("seen")).collect()[0].applied_at == dt.date(2020, 2, 29)


def test_dim_time_has_no_cap_and_no_gaps(spark):
    apps = spark.createDataFrame([(dt.date(2020, 12, 30),), (dt.date(2024, 1, 2),), (None,)], "applied_at date")
    rows = star.dim_time(apps).orderBy("date_key").collect()
    assert len(rows) == (dt.date(2024, 1, 2) - dt.date(2020, 12, 30)).days + 1
    assert tuple(rows[0]) == (dt.date(2020, 12, 30), 2020, 4, 12, 52)
    assert tuple(rows[2]) == (dt.date(2021, 1, 1), 2021, 1, 1, 0)


@pytest.mark.parametrize("name", ["dim_python", "dim_internship", "dim_recruiter", "dim_source", "dim_role"])
def test_listed_dimensions(spark, name):
    dim = star.listed_dims(spark)[name]
    assert dim.columns == TABLES[name].names
    values = {
        "dim_recruiter": ["Rita", "Sam", "Ava", "Leo"],
        "dim_source": ["Referral", "LinkedIn", "Job Board", "Career Site"],
        "dim_role": ["Data Analyst", "Data Engineer", "ML Engineer", "BI Analyst"],
    }.get(name, [0, 1])
    assert [tuple(r) for r in dim.collect()] == list(enumerate(values, 1))


def test_raw_file_as_text(spark, tmp_path):
    header = "Serial_no,Gender,Education,Experience_Years,Python_exp,Internship,Score,Location,Salary * 10E4"
    path = tmp_path / "raw.csv"
    path.write_text(
        f"{header},Offer_History,Recruitment_Status\n"
        "1,Male,Graduate,3+,Yes,No,4500,Urban,1.25,1,Y\n"
        "2,,Not Graduate,1,No,Yes,,Rural,x,0,N\n"
        "3,Female,Graduate,,No,No,2.0,Semiurban,2,1.0,N\n"
        "4,Female,Graduate,NaN,No,No,2.5,Semiurban,1e400,99999999999,N\n"
    )
    failures = {r.column_name: r.failed_casts for r in cast_failures(read_raw_text(spark, str(path))).collect()}
    assert failures == {
        "serial_no": 0, "experience_years": 2, "score": 1, "salary_band": 1, "offer_history": 1, BROKEN_LINE: 0,
    }
    raw = read_raw(spark, str(path))
    assert raw.schema == RAW
    rows = [tuple(r) for r in raw.orderBy("serial_no").collect()]
    assert rows == [
        (1, "Male", "Graduate", None, "Yes", "No", 4500, "Urban", 1.25, 1, "Y"),
        (2, None, "Not Graduate", 1, "No", "Yes", None, "Rural", None, 0, "N"),
        (3, "Female", "Graduate", None, "No", "No", 2, "Semiurban", 2.0, 1, "N"),
        (4, "Female", "Graduate", None, "No", "No", None, "Semiurban", float("inf"), None, "N"),
    ]


def test_lines_with_too_many_or_too_few_fields_are_counted(spark, tmp_path):
    sound = "1,Male,Graduate,3,Yes,No,4500,Urban,1.25,1,Y"
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([",".join(RAW_SOURCE_NAMES), sound, "2" + sound[1:] + ",more,and more", "3,Male", ""]))
    text = read_raw_text(spark, str(path))
    failures = {r.column_name: r.failed_casts for r in cast_failures(text).collect()}
    assert failures[BROKEN_LINE] == 2 and sum(failures.values()) == 2
    marked = text.where(F.col(BROKEN_LINE).isNotNull()).orderBy("serial_no").collect()
    assert [r[BROKEN_LINE] for r in marked] == ["2" + sound[1:] + ",more,and more", "3,Male"]
    assert read_raw(spark, str(path)).columns == RAW.names and read_raw(spark, str(path)).count() == 3


def test_more_columns_pass_the_typing(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(",".join([*RAW_SOURCE_NAMES, "Seen"]) + "\n1,Male,Graduate,3,Yes,No,4500,Urban,1.25,1,Y,2020-02-29\n")
    raw = read_raw(spark, str(path), extra=["Seen"])
    assert raw.columns == [*RAW.names, "Seen"]
    assert load.applications(raw, applied_on=F.col("Seen")).collect()[0].applied_at == dt.date(2020, 2, 29)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_raw_formats(spark, tmp_path, fmt):
    raw = golden.golden_raw(spark)
    writer = raw.toDF(*RAW_SOURCE_NAMES).write.format(fmt)
    writer.option("header", True).save(str(tmp_path / "raw"))
    again = read_raw(spark, str(tmp_path / "raw"), fmt)
    assert again.schema == RAW
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, raw.collect()))


def test_a_csv_with_other_columns_is_refused(spark, tmp_path):
    names = [*RAW_SOURCE_NAMES[1:], RAW_SOURCE_NAMES[0]]
    (tmp_path / "raw.csv").write_text(",".join(names) + "\n" + ",".join("1" * len(names)) + "\n")
    with pytest.raises(Exception, match="CSV header"):
        read_raw(spark, str(tmp_path / "raw.csv")).collect()


def test_column_types_match_the_declared_tables(spark):
    raw = golden.golden_raw(spark)
    rows = load.journeys(raw)
    dims = star.dimensions(load.candidates(raw))
    frames = dims | {
        "candidates": load.candidates(raw),
        "applications": load.applications(raw),
        "stage_events": stages.closed_stage_events(rows),
        "dim_time": star.dim_time(load.applications(raw)),
        "fact_application": star.fact_application(rows, dims),
        "fact_stage_event": star.fact_stage_event(stages.closed_stage_events(rows)),
    }
    assert set(frames) == set(TABLES)
    for name, df in frames.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TABLES[name]], name
