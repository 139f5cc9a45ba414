"""Facts in buckets: same results, no shuffle by application."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import golden
from stagelight.operators import marts
from stagelight.sources import bucketed
from stagelight.sources.bucketed import FACTS, read_bucketed, write_bucketed
from stagelight.sources.warehouse import read_tables, write_tables


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plain"))
    write_tables(golden.golden_raw(spark), folder)
    tables = read_tables(spark, folder)
    place = str(tmp_path_factory.mktemp("buckets") / "facts")
    return tables, place, write_bucketed(tables, place, 6)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def results(facts, dims):
    reached = marts.with_reached(facts["fact_application"], facts["fact_stage_event"])
    return {"slice": marts.funnel_by_slice(reached, dims), "cohort": marts.cohort_conversion(reached)}


@pytest.mark.parametrize("name", ["slice", "cohort"])
def test_same_rows_without_a_shuffle_by_application(spark, stored, no_broadcast, name):
    tables, _, facts = stored
    plain, laid_out = results(tables, tables)[name], results(facts, tables)[name]
    assert rows_of(laid_out) == rows_of(plain)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (plain, laid_out)]
    shuffles = [len(re.findall(r"Exchange hashpartitioning\(application_id", plan)) for plan in plans]
    assert shuffles[0] >= 2 and shuffles[1] == 0


def test_another_session_reads_the_layout(spark, stored):
    tables, place, facts = stored
    expected = {name: rows_of(facts[name]) for name in FACTS}
    assert all(expected.values())
    assert expected == {name: rows_of(tables[name]) for name in FACTS}
    bucketed.forget_bucketed(spark, place)
    again = read_bucketed(spark, place)
    assert {name: rows_of(again[name]) for name in FACTS} == expected


def test_one_file_a_bucket(stored):
    for name in FACTS:
        assert 1 <= len(list(Path(stored[1], name).glob("*.parquet"))) <= 6


def test_a_hot_application_is_refused_before_anything_is_written(spark, stored, tmp_path, monkeypatch):
    tables, _, _ = stored
    monkeypatch.setattr(bucketed.refuse_hot, "__defaults__", (20,))
    one = tables["fact_stage_event"].where(F.col("application_id") == 1)
    events = tables["fact_stage_event"].unionByName(one.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("k"))
    with pytest.raises(ValueError, match="1 applications have over 20 rows"):
        write_bucketed({**tables, "fact_stage_event": events}, str(tmp_path / "hot"), 4)
    assert not (tmp_path / "hot").exists()


def test_empty_facts(spark, stored, tmp_path):
    tables, _, _ = stored
    empty = write_bucketed({name: tables[name].limit(0) for name in FACTS}, str(tmp_path / "empty"), 4)
    assert [df.count() for df in empty.values()] == [0, 0]
