"""Batches against one load of everything."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import golden
from stagelight.operators import marts, star
from stagelight.plans.bitmaps import key_index, unfolded
from stagelight.schemas import RAW, RAW_SOURCE_NAMES, TABLES
from stagelight.operators.states import view_frames
from stagelight.sources import batches
from stagelight.sources.batches import append_files, append_tables, compacted
from stagelight.sources.views import create_views, result_frames
from stagelight.sources.warehouse import (
    all_loads,
    current_loads,
    read_index,
    read_states,
    read_table,
    read_tables,
    write_tables,
)

PARTS = {"b": (0, 250), "a": (250, 260), "c": (260, 614)}


def part(spark, name, extra=None):
    first, last = PARTS[name]
    rows = golden.raw_rows()[first:last]
    return spark.createDataFrame([tuple({**r, **(extra or {})}.values()) for r in rows], RAW)


def rows_of(df, columns=None):
    return sorted(map(repr, df.select(columns or df.columns).collect()))


def named(tables):
    """All tables, with members in place of their keys."""
    plain = {name: rows_of(tables[name]) for name in TABLES if name.startswith(("cand", "app", "stage", "fact_s", "dim_t"))}
    for name in ("dim_education", "dim_location"):
        plain[name] = rows_of(tables[name], TABLES[name].names[1:])
    for name in star.LISTED:
        plain[name] = rows_of(tables[name])
    plain["fact"] = rows_of(marts.applications_flat_star(tables["fact_application"], tables))
    return plain


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    return named(write_tables(golden.golden_raw(spark), str(tmp_path_factory.mktemp("whole"))))


@pytest.mark.parametrize("order", ["cab"])
def test_batches_in_any_order_give_the_tables_of_one_load(spark, tmp_path, whole, order):
    folder = str(tmp_path)
    for name in order:
        assert append_tables(part(spark, name), folder, name)
        assert not append_tables(part(spark, name), folder, name)
    tables = read_tables(spark, folder)
    assert named(tables) == whole
    assert [tuple(r) for r in marts.stage_durations(tables["fact_stage_event"]).collect()] == golden.DURATIONS


@pytest.mark.parametrize("stop", ["dim_location", "fact_application"])
def test_a_batch_that_stops_between_two_tables_adds_nothing_and_can_come_again(
    spark, tmp_path, whole, monkeypatch, stop
):
    folder = str(tmp_path)
    append_tables(part(spark, "b"), folder, "b")
    before = named(read_tables(spark, folder))
    write = batches.write_table

    def stops(df, own, name):
        if name == stop:
            raise OSError("no space")
        return write(df, own, name)

    with monkeypatch.context() as patch:
        patch.setattr(batches, "write_table", stops)
        with pytest.raises(OSError):
            append_tables(part(spark, "c"), folder, "c")
    assert named(read_tables(spark, folder)) == before
    assert len(list(tmp_path.glob("load-*"))) == 1
    assert append_tables(part(spark, "c"), folder, "c") and append_tables(part(spark, "a"), folder, "a")
    assert named(read_tables(spark, folder)) == whole


def places(spark, folder):
    dims = {name: read_table(spark, folder, name).collect() for name in ("dim_education", "dim_location")}
    return {name: {row[1]: row[0] for row in rows} for name, rows in dims.items()}


def test_keys_of_members_last_without_a_gap(spark, tmp_path):
    folder, seen = str(tmp_path), {}
    for k, (name, location) in enumerate([("b", "M"), ("a", "A"), ("c", "Z")]):
        rows = part(spark, name).withColumn("location", F.when(F.col("serial_no") % 2 == 0, location).otherwise("M"))
        append_tables(rows, folder, name)
        found = places(spark, folder)["dim_location"]
        assert all(found[member] == key for member, key in seen.items())
        assert sorted(found.values()) == list(range(1, len(found) + 1)) and len(found) == k + 1
        assert not append_tables(rows, folder, name)
        assert places(spark, folder)["dim_location"] == found
        seen = found
    assert seen == {"M": 1, "A": 2, "Z": 3}
    facts = read_table(spark, folder, "fact_application").groupBy("location_key").count().collect()
    assert {r.location_key for r in facts} == {1, 2, 3} and sum(r["count"] for r in facts) == 614


def test_many_new_members_at_once_are_numbered_in_order_after_the_old_ones(spark):
    old = spark.createDataFrame([(1, "m50"), (2, "zz"), (3, "m07")], TABLES["dim_location"])
    values = [f"m{k:02}" for k in range(100)] + [None]
    candidates = spark.createDataFrame([(v,) for v in values * 3], "location string").repartition(7)
    added = star.new_members(candidates, {"dim_location": old})["dim_location"].collect()
    fresh = sorted(v for v in values if v and v not in ("m50", "m07"))
    assert sorted((r.location, r.location_key) for r in added) == [(v, 4 + k) for k, v in enumerate(fresh)]


def test_stored_ids_are_refused_before_a_row_is_written(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    append_tables(part(spark, "b"), folder, "b")
    append_tables(part(spark, "a"), folder, "a")
    read, written = [], []
    own_read, own_write = batches.read_index, batches.write_table
    monkeypatch.setattr(batches, "read_index", lambda s, f: (read.append("index"), own_read(s, f))[1])
    monkeypatch.setattr(batches, "read_tables", lambda *a: read.append("tables"))
    monkeypatch.setattr(batches, "write_table", lambda df, f, name: (written.append(name), own_write(df, f, name))[1])
    again = part(spark, "c").union(part(spark, "a").limit(3))
    with pytest.raises(ValueError, match=r"3 ids of the batch are stored already, among them \[251, 252, 253\]"):
        append_tables(again, folder, "c")
    assert read == ["index"] and written == []
    assert read_table(spark, folder, "candidates").count() == 260
    for broken in (part(spark, "c").union(part(spark, "c").limit(1)), part(spark, "c", {"serial_no": None})):
        with pytest.raises(ValueError, match="raw rows have no serial_no or repeat one"):
            append_tables(broken, folder, "c")
    assert written == [] and len(list(tmp_path.glob("load-*"))) == 2


def test_the_test_for_stored_ids_reads_the_index_in_range(spark, tmp_path):
    folder = str(tmp_path)
    append_tables(part(spark, "b"), folder, "b")
    index = key_index(part(spark, "c").withColumnRenamed("serial_no", "candidate_id"), "candidate_id")
    stored = read_index(spark, folder).where(F.col("chunk").between(1, 2))
    shared = batches.shared_keys(index, stored)
    assert shared.count() == 0
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(chunk,1)" in plan and "LessThanOrEqual(chunk,2)" in plan
    assert all("/key_index/" in path for path in stored.inputFiles())


def test_an_index_holds_any_integral_keys(spark):
    rng = random.Random(5)
    keys = [rng.randrange(-(2**62), 2**62) for _ in range(500)] + list(range(-300, 700)) + [2**63 - 1, -(2**63), 7, None]
    index = key_index(spark.createDataFrame([(k,) for k in keys], "id long").repartition(6), "id")
    assert sorted(r.id for r in unfolded(index, "id").collect()) == sorted(set(keys) - {None})
    assert index.agg(F.sum("n")).first()[0] == len(keys)
    other = key_index(spark.createDataFrame([(k,) for k in [5, 2**63 - 1, 900, None]], "id long"), "id")
    assert sorted(r.id for r in unfolded(batches.shared_keys(index, other), "id").collect()) == [5, 2**63 - 1]


def test_a_dense_index_takes_a_fraction_of_a_byte_per_key(spark):
    rows = spark.range(0, 1 << 20, 1, 8).withColumnRenamed("id", "candidate_id")
    index = key_index(rows, "candidate_id")
    assert index.count() == (1 << 20) // 256  # forty-eight bytes for 256 keys, whatever the rows
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_a_calendar_grows_on_both_sides_without_a_gap(spark):
    def days(first, last):
        return [dt.date(2024, 1, 1) + dt.timedelta(d) for d in range(first, last)]

    def applied(dates):
        return spark.createDataFrame([(1, 1, d, 0) for d in dates], TABLES["applications"])

    stored = star.dim_time(applied([days(100, 101)[0], days(109, 110)[0]]))
    cases = [([50, 60], [*range(50, 100)]), ([130], [*range(110, 131)]), ([103, 105], []), ([99, 110], [99, 110]),
             ([1, 300], [*range(1, 100), *range(110, 301)])]
    for offsets, new in cases:
        found = star.new_days(applied([days(o, o + 1)[0] for o in offsets]), stored).collect()
        assert sorted(r.date_key for r in found) == [days(o, o + 1)[0] for o in new]
    assert star.new_days(applied([None]), stored).count() == 0
    assert star.new_days(applied(days(1, 4)), star.dim_time(applied([None]))).count() == 3


def test_batches_after_a_load_and_a_load_after_batches(spark, tmp_path, whole):
    folder = str(tmp_path)
    write_tables(part(spark, "b"), folder)
    append_tables(part(spark, "a"), folder, "a")
    with pytest.raises(ValueError, match="stored already"):
        append_tables(part(spark, "b"), folder, "b")
    append_tables(part(spark, "c"), folder, "c")
    assert named(read_tables(spark, folder)) == whole
    write_tables(part(spark, "a"), folder)
    assert read_table(spark, folder, "candidates").count() == 10
    assert append_tables(part(spark, "c"), folder, "c")
    assert len(list(tmp_path.glob("load-*"))) == 5  # the three before the second load stay for whoever reads them
    write_tables(golden.golden_raw(spark), folder)
    assert len(list(tmp_path.glob("load-*"))) == 3


def test_many_batches_become_one_load_that_knows_them(spark, tmp_path, whole):
    folder = str(tmp_path)
    for name in "cba":
        append_tables(part(spark, name), folder, name)
    keys = places(spark, folder)
    tables = compacted(spark, folder)
    assert named(tables) == whole and places(spark, folder) == keys
    (load,) = current_loads(all_loads(spark, folder))
    assert load.batches == ("c", "b", "a")
    assert not append_tables(part(spark, "b"), folder, "b")
    with pytest.raises(ValueError, match="stored already"):
        append_tables(part(spark, "b"), folder, "other name")


def test_views_over_batches_read_states_and_equal_a_recomputation(spark, tmp_path):
    folder = str(tmp_path)
    for name in "ab":
        append_tables(part(spark, name), folder, name)
    odd = part(spark, "c", {"score": None, "education": None})
    append_tables(odd.unionByName(odd.withColumn("serial_no", F.col("serial_no") + 1000)), folder, "c")
    for _ in range(2):
        tables = read_tables(spark, folder)
        views = view_frames(read_states(spark, folder), tables)
        for name, df in result_frames(tables).items():
            if name in views:
                assert views[name].columns == df.columns
                assert rows_of(views[name]) == rows_of(df), name
                read = {p.split("/")[-2] for p in views[name].inputFiles()}
                assert read <= {"view_states", "dim_role", "dim_source", "dim_recruiter"}
        compacted(spark, folder)
    create_views(tables, states=read_states(spark, folder))
    assert spark.sql("select sum(apps) from v_score_band").first()[0] == 968
    empty = view_frames(read_states(spark, folder).limit(0), tables)
    assert empty["v_funnel_counts"].count() == 0 and empty["v_conversion_overall"].first().applied is None


def test_files_are_batches(spark, tmp_path, whole):
    source, folder = tmp_path / "raw", str(tmp_path / "tables")
    source.mkdir()
    rows = golden.raw_rows()

    def deliver(name):
        lines = [",".join("" if v is None else str(v) for v in r.values()) for r in rows[slice(*PARTS[name])]]
        (source / f"{name}.csv").write_text("\n".join([",".join(RAW_SOURCE_NAMES), *lines]) + "\n")

    deliver("b")
    deliver("c")
    (source / "_note").write_text("not a batch")
    assert append_files(spark, str(source), folder) == ["b.csv", "c.csv"]
    assert append_files(spark, str(source), folder) == []
    deliver("a")
    assert append_files(spark, str(source), folder) == ["a.csv"]
    assert named(read_tables(spark, folder)) == whole


def test_an_empty_batch_is_taken(spark, tmp_path):
    folder = str(tmp_path)
    assert append_tables(part(spark, "a").limit(0), folder, "nothing")
    assert append_tables(part(spark, "a"), folder, "a")
    assert read_table(spark, folder, "fact_application").count() == 10
    assert places(spark, folder)["dim_location"]
