"""Events merged batch by batch against a full rebuild."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import golden
from stagelight.operators import load, marts, stages
from stagelight.schemas import STAGE_NAMES, TABLES
from stagelight.sources import event_store
from stagelight.sources.event_store import changes, drop_old_versions, merge_events, read_events

SCHEMA = TABLES["stage_events"]


def rows_of(df):
    return sorted(map(repr, df.select(SCHEMA.names).collect()))


def files(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet")}


def by_stage(spark):
    """The golden events, in three batches by stage, so that later ones change exits of earlier ones."""
    events = stages.stage_events(load.journeys(golden.golden_raw(spark)))
    names = [["Applied", "Hired"], ["Interviewed"], ["Screened", "Offered"]]
    return [events.where(F.col("stage_name").isin(some)) for some in names], events


def test_batches_in_any_order_equal_a_rebuild(spark, tmp_path):
    batches, events = by_stage(spark)
    for k in (1, 2, 0):
        assert merge_events(batches[k], str(tmp_path), f"b{k}", buckets=8)
        assert not merge_events(batches[k], str(tmp_path), f"b{k}")
    stored = read_events(spark, str(tmp_path))
    assert rows_of(stored) == rows_of(stages.stage_events_closed(events))
    assert [tuple(r) for r in marts.stage_durations(stored).collect()] == golden.DURATIONS


def test_only_touched_buckets_have_new_files(spark, tmp_path):
    batches, _ = by_stage(spark)
    merge_events(batches[0], str(tmp_path), "first", buckets=16)
    before = files(tmp_path)
    one = batches[1].where(F.col("application_id").isin(5, 7))
    hit = {r[0] for r in one.select(F.pmod(F.hash("application_id"), F.lit(16))).distinct().collect()}
    merge_events(one, str(tmp_path), "second")
    new = files(tmp_path) - before
    assert before <= files(tmp_path)
    assert {name.split("bucket=")[1].split("/")[0] for name in new} == set(map(str, hit))
    assert set(changes(spark, str(tmp_path))[-1].touched) == hit and len(hit) < 3
    assert rows_of(read_events(spark, str(tmp_path))) == rows_of(stages.stage_events_closed(batches[0].unionByName(one)))


def test_old_versions_go_when_asked(spark, tmp_path):
    batches, events = by_stage(spark)
    for k, batch in enumerate(batches):
        merge_events(batch, str(tmp_path), str(k), buckets=4)
    assert drop_old_versions(spark, str(tmp_path)) > 0
    assert rows_of(read_events(spark, str(tmp_path))) == rows_of(stages.stage_events_closed(events))
    current = event_store.current_versions(changes(spark, str(tmp_path)))
    assert {name.rsplit("/", 1)[0] for name in files(tmp_path)} == {f"{v}/bucket={b}" for b, v in current.items()}


def test_a_batch_that_stops_changes_nothing_and_can_come_again(spark, tmp_path, monkeypatch):
    batches, events = by_stage(spark)
    merge_events(batches[0], str(tmp_path), "0", buckets=4)
    before = rows_of(read_events(spark, str(tmp_path)))

    def stops(rows):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(event_store, "stage_events_closed", stops)
        with pytest.raises(OSError):
            merge_events(batches[1], str(tmp_path), "1")
    assert rows_of(read_events(spark, str(tmp_path))) == before
    assert len(list(tmp_path.glob("version-*"))) == 1
    assert merge_events(batches[1], str(tmp_path), "1") and merge_events(batches[2], str(tmp_path), "2")
    assert rows_of(read_events(spark, str(tmp_path))) == rows_of(stages.stage_events_closed(events))


def test_repeats_nulls_ties_and_a_hot_application(spark, tmp_path):
    rng = random.Random(8)
    names = [*STAGE_NAMES, None]
    rows = []
    for k in range(3000):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(9))
        app = 1 if k % 3 == 0 else rng.choice([None, *range(2, 60)])
        values = dict(
            stage_event_id=rng.choice([None, rng.randrange(2000)]), application_id=app, stage_name=rng.choice(names),
            stage_entered_at=rng.choice([None, day, day]), stage_exited_at=None,
        )
        rows.append(tuple(values[c] for c in SCHEMA.names))
    rows += rows[:50]
    for k in range(4):
        merge_events(spark.createDataFrame(rows[k::4], SCHEMA), str(tmp_path), str(k), buckets=5)
    whole = stages.stage_events_closed(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(read_events(spark, str(tmp_path))) == rows_of(whole)


def test_empty_batches_and_empty_folder(spark, tmp_path):
    folder = str(tmp_path / "events")
    assert read_events(spark, folder).collect() == []
    empty = spark.createDataFrame([], SCHEMA)
    assert merge_events(empty, folder, "none") and not merge_events(empty, folder, "none")
    assert read_events(spark, folder).collect() == []
