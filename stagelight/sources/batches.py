"""Batches that add to the stored tables: base tables, dimensions and facts, taken once each.

A batch is written to a folder of its own like any load (``sources.warehouse``). One line in ``_loads`` then adds all of
its tables and its name at once, so a batch that stops half way adds nothing, and one that is offered again is known by
its name. Nothing that is stored is written again: members of dimensions keep their keys, facts refer to them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.operators import star
from stagelight.operators.load import journeys
from stagelight.operators.marts import applications_flat
from stagelight.plans.bitmaps import BITS, count_bits, unfolded
from stagelight.plans.shared import remove, scratch, written
from stagelight.schemas import BASE_DATE, STAGES, Stage
from stagelight.sources.raw import rename_raw, text_reader, typed
from stagelight.sources.warehouse import (
    STATES_TABLE,
    all_loads,
    base_frames,
    commit,
    current_loads,
    drop_old_loads,
    read_index,
    read_states,
    read_tables,
    require_keys,
    require_values,
    write_index,
    write_states,
    write_table,
)


def shared_keys(index: DataFrame, stored: DataFrame) -> DataFrame:
    """The bits that two key indexes have in common: chunk, n and bits. Chunks meet by number."""
    other = stored.select("chunk", *[F.col(b).alias(f"stored_{b}") for b in BITS])
    both = [F.col(b).bitwiseAND(F.col(f"stored_{b}")).alias(b) for b in BITS]
    found = index.join(other, "chunk").select("chunk", *both)
    return found.withColumn("n", count_bits([F.col(b) for b in BITS]).cast("long")).where(F.col("n") > 0)


def refuse_stored(index: DataFrame, stored: DataFrame) -> None:
    """Fail if a key of ``index`` is stored. Of the stored index, only the range of chunks in question is read."""
    span = index.agg(F.min("chunk").alias("first"), F.max("chunk").alias("last")).first()
    if span.first is None:
        return
    again = shared_keys(index, stored.where(F.col("chunk").between(span["first"], span["last"])))
    count = again.agg(F.sum("n").alias("n")).first().n
    if count:
        some = sorted(row.key for row in unfolded(again, "key").limit(5).collect())
        raise ValueError(f"{count} ids of the batch are stored already, among them {some}")


def append_tables(
    raw: DataFrame,
    folder: str,
    batch: str,
    base: dt.date = BASE_DATE,
    applied_on: Column | None = None,
    stages: Sequence[Stage] = STAGES,
    assigned: dict[str, Column] | None = None,
) -> bool:
    """Add raw rows to all tables under ``folder`` as the batch of that name; False if the tables have it already.

    The tables are those of one load of all batches, in whatever order they come, but that dimension keys are lasting:
    a member keeps the key it got first, and new ones are numbered on. The arguments are those of ``write_tables`` and
    must be the same for all batches.

    A serial_no that is NULL, repeated in the batch or stored before stops the batch before a row is written. The test
    reads the ids of the batch and the stored index of ids, never the stored rows. A NULL in a required column stops
    it too. Whatever stops a batch, the tables stay as they were, and it can be offered again under its name. One batch
    at a time may be added.
    """
    spark = raw.sparkSession
    current = current_loads(all_loads(spark, folder))
    if any(batch in load.batches for load in current):
        return False
    load = f"load-{uuid.uuid4().hex}"
    own = f"{folder}/{load}"
    try:
        with scratch(spark):
            rows = written(journeys(raw, base, applied_on, stages), "journeys")
            index = write_index(rows, own)
            require_keys(index)
            if current:
                refuse_stored(index, read_index(spark, folder))
            tables = {name: write_table(df, own, name) for name, df in base_frames(rows, stages).items()}
            require_values(tables)
            dims = _merged_dims(tables, read_tables(spark, folder) if current else {}, own)
            write_table(star.fact_application(applications_flat(rows), dims, assigned), own, "fact_application")
            write_table(star.fact_stage_event(tables["stage_events"]), own, "fact_stage_event")
            write_states(rows, own, stages, assigned)
    except BaseException:
        remove(spark, own)
        raise
    commit(spark, folder, load, appends=bool(current), batches=[batch])
    return True


def _merged_dims(tables: dict[str, DataFrame], stored: dict[str, DataFrame], own: str) -> dict[str, DataFrame]:
    """Write what a batch adds to the dimensions; returns all their members, but the calendar's."""
    candidates, applications = tables["candidates"], tables["applications"]
    if not stored:
        dims = star.dimensions(candidates)
        write_table(star.dim_time(applications), own, "dim_time")
        return {name: write_table(dim, own, name) for name, dim in dims.items()}
    attributes = {name: stored[name] for name in star.ATTRIBUTES}
    added = {name: write_table(dim, own, name) for name, dim in star.new_members(candidates, attributes).items()}
    write_table(star.new_days(applications, stored["dim_time"]), own, "dim_time")
    return {name: stored[name].unionByName(dim) for name, dim in added.items()} | {
        name: stored[name] for name in star.LISTED
    }


def append_files(
    spark: SparkSession,
    source: str,
    folder: str,
    base: dt.date = BASE_DATE,
    applied_on: Column | None = None,
    stages: Sequence[Stage] = STAGES,
    extra: Sequence[str] = (),
    assigned: dict[str, Column] | None = None,
) -> list[str]:
    """Add every raw CSV file under ``source`` that is not stored yet as a batch named after it, in order of names;
    returns the names added. A file that is refused stops the call; those before it stay."""
    place = spark._jvm.org.apache.hadoop.fs.Path(source)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    names = sorted(file.getPath().getName() for file in files if file.isFile())
    added = []
    for name in names:
        if name.startswith(("_", ".")):
            continue
        raw = typed(rename_raw(text_reader(spark.read, "csv", extra).load(f"{source}/{name}"), extra))
        if append_tables(raw, folder, name, base, applied_on, stages, assigned):
            added.append(name)
    return added


def compacted(spark: SparkSession, folder: str, stages: Sequence[Stage] = STAGES) -> dict[str, DataFrame]:
    """Write the tables of many batches again as one load that replaces them; keys and names of batches are kept."""
    current = current_loads(all_loads(spark, folder))
    load = f"load-{uuid.uuid4().hex}"
    own = f"{folder}/{load}"
    try:
        tables = {name: write_table(df, own, name) for name, df in read_tables(spark, folder).items()}
        write_index(tables["candidates"], own)
        read_states(spark, folder, stages).coalesce(1).write.parquet(f"{own}/{STATES_TABLE}")
    except BaseException:
        remove(spark, own)
        raise
    commit(spark, folder, load, batches=[batch for one in current for batch in one.batches])
    drop_old_loads(spark, folder)
    return read_tables(spark, folder)
