"""Incremental load against the batch load."""

import pytest

import golden
from stagelight.operators import marts
from stagelight.schemas import RAW_SOURCE_NAMES
from stagelight.sources.raw import read_raw
from stagelight.sources.warehouse import BASE_TABLES, read_table, write_star, write_tables
from stagelight.streaming.incremental import load_new_files


@pytest.fixture
def deliver(spark, tmp_path):
    """Write some of the golden rows as one more raw file."""
    source = tmp_path / "raw"
    source.mkdir()
    rows = golden.raw_rows()

    def deliver(name, first, last):
        columns = [",".join("" if v is None else str(v) for v in r.values()) for r in rows[first:last]]
        (source / name).write_text("\n".join([",".join(RAW_SOURCE_NAMES), *columns]) + "\n")
        return str(source)

    return deliver


def snapshot(spark, folder):
    return {name: sorted(map(repr, read_table(spark, folder, name).collect())) for name in BASE_TABLES}


def test_files_are_loaded_once_and_give_the_batch_result(spark, tmp_path, deliver):
    stream, batch = str(tmp_path / "stream"), str(tmp_path / "batch")
    source = deliver("a.csv", 0, 400)
    assert load_new_files(spark, source, stream) == 0
    assert read_table(spark, stream, "applications").count() == 400
    assert load_new_files(spark, source, stream) == 0
    assert read_table(spark, stream, "applications").count() == 400
    deliver("b.csv", 400, 614)
    load_new_files(spark, source, stream)
    load_new_files(spark, source, stream)
    stored = write_tables(read_raw(spark, source), batch)
    assert snapshot(spark, stream) == snapshot(spark, batch)

    base = {name: read_table(spark, stream, name) for name in BASE_TABLES}
    flat = marts.applications_flat_from_tables(base["applications"], base["candidates"])
    star = write_star(base, flat, stream)
    for name, table in star.items():
        assert sorted(map(repr, table.collect())) == sorted(map(repr, stored[name].collect())), name
    assert [tuple(r) for r in marts.stage_durations(star["fact_stage_event"]).collect()] == golden.DURATIONS


def test_ids_loaded_before_are_reported(spark, tmp_path, deliver):
    source = deliver("a.csv", 0, 50)
    assert load_new_files(spark, source, str(tmp_path / "stream")) == 0
    deliver("b.csv", 40, 60)
    assert load_new_files(spark, source, str(tmp_path / "stream")) == 10
