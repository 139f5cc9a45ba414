"""The stored tables. A load replaces them all at once, so loading the same rows twice gives the same tables.

A load writes to a folder of its own, ``load-...``, and checks what it wrote; only then a line in ``_loads`` makes it
the one that is read. A load that fails leaves the tables as they were. A line may say that its load adds to those before
it, as batches do (``sources.batches``); then a table is read from the folders of all of them. Tables that lie directly
in the folder, as the incremental load writes them, are read where there is no such line.

Beside its tables a load keeps an index of the candidate ids in it, as bits, and its states of the aggregate views
(``operators.states``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stagelight.operators import star, states
from stagelight.operators.load import journeys
from stagelight.operators.marts import applications_flat
from stagelight.operators.stages import closed_stage_events
from stagelight.plans.bitmaps import BITS, INDEX, count_bits, key_index
from stagelight.plans.shared import remove, scratch
from stagelight.schemas import BASE_DATE, CONSTRAINTS, STAGES, TABLES, Stage

BASE_TABLES = ["candidates", "applications", "stage_events"]
KEY_INDEX, STATES_TABLE = "key_index", "view_states"
LOADS = "number long, load string, appends boolean, batches array<string>"


class Load(NamedTuple):
    """A load that came to its end: its folder, whether it adds to the one before, and the batches in it."""

    number: int
    load: str
    appends: bool
    batches: tuple[str, ...]


def conformed(df: DataFrame, name: str) -> DataFrame:
    """The columns of a table in declared order and type."""
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in TABLES[name]])


def all_loads(spark: SparkSession, folder: str) -> list[Load]:
    """Every load that came to its end, oldest first. A line per load."""
    try:
        rows = spark.read.schema(LOADS).json(f"{folder}/_loads").collect()
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return []
    loads = [Load(r["number"], r["load"], bool(r["appends"]), tuple(r["batches"] or ())) for r in rows]
    return sorted(loads)


def current_loads(loads: Sequence[Load]) -> list[Load]:
    """The loads whose tables are read: the last one that replaced all others, and those added since."""
    start = max((k for k, load in enumerate(loads) if not load.appends), default=0)
    return list(loads[start:])


def commit(spark: SparkSession, folder: str, load: str, appends: bool = False, batches: Sequence[str] = ()) -> None:
    """Make a written load one that is read. The line is committed as a whole; one load at a time may do this."""
    loads = all_loads(spark, folder)
    number = loads[-1].number + 1 if loads else 1
    line = spark.createDataFrame([(number, load, appends, list(batches))], LOADS).coalesce(1)
    line.write.mode("append").json(f"{folder}/_loads")


def drop_old_loads(spark: SparkSession, folder: str) -> None:
    """Remove what is no longer read, but for the tables that were read before the last replacement."""
    loads = all_loads(spark, folder)
    now = len(loads) - len(current_loads(loads))
    before = now - len(current_loads(loads[:now]))
    for old in loads[:before]:
        remove(spark, f"{folder}/{old.load}")


def _read(
    spark: SparkSession, folder: str, loads: Sequence[Load], name: str, schema: StructType | str | None = None
) -> DataFrame:
    """A table over its loads. Dimensions of given members are in the first one alone."""
    places = [f"{folder}/{load.load}" for load in loads] or [folder]
    if name in star.LISTED:
        places = places[:1]
    return spark.read.schema(schema or TABLES[name]).parquet(*[f"{place}/{name}" for place in places])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _read(spark, folder, current_loads(all_loads(spark, folder)), name)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of all stored candidate ids."""
    return _read(spark, folder, current_loads(all_loads(spark, folder)), KEY_INDEX, INDEX)


def read_states(spark: SparkSession, folder: str, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """What every load adds to the aggregate views."""
    return _read(spark, folder, current_loads(all_loads(spark, folder)), STATES_TABLE, states.schema(stages))


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    loads = current_loads(all_loads(spark, folder))
    return {name: _read(spark, folder, loads, name) for name in TABLES}


def write_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Replace a table and read it back. Dimensions are not compressed, so that joins see their real size."""
    writer = conformed(df, name).write.mode("overwrite")
    if name.startswith("dim_"):
        writer = writer.option("compression", "uncompressed")
    writer.parquet(f"{folder}/{name}")
    return _read(df.sparkSession, folder, [], name)


def write_index(candidates: DataFrame, folder: str) -> DataFrame:
    """Write the index of candidate ids, in order, so that a range of ids is read alone; and read it back."""
    ordered = key_index(candidates, "candidate_id").repartitionByRange("chunk").sortWithinPartitions("chunk")
    ordered.write.parquet(f"{folder}/{KEY_INDEX}")
    return _read(candidates.sparkSession, folder, [], KEY_INDEX, INDEX)


def write_states(
    rows: DataFrame, folder: str, stages: Sequence[Stage] = STAGES, assigned: dict[str, Column] | None = None
) -> None:
    """Write the states of a load's journeys: a few rows per group, in one file."""
    states.load_states(rows, stages, assigned).coalesce(1).write.parquet(f"{folder}/{STATES_TABLE}")


def base_frames(rows: DataFrame, stages: Sequence[Stage] = STAGES) -> dict[str, DataFrame]:
    """Candidates, applications and closed stage events: projections of journeys, batch or streaming."""
    return {
        "candidates": rows.select(TABLES["candidates"].names),
        "applications": rows.select(TABLES["applications"].names),
        "stage_events": closed_stage_events(rows, stages),
    }


def write_star(
    base_tables: dict[str, DataFrame], flat: DataFrame, folder: str, assigned: dict[str, Column] | None = None
) -> dict[str, DataFrame]:
    """Write dimensions and facts from the stored base tables and record-level rows of applications.

    Dimensions come first, so that the fact joins stored tables of known size; they read a few columns of stored
    tables rather than the raw rows again.
    """
    with scratch(flat.sparkSession):
        dims = star.dimensions(base_tables["candidates"]) | {"dim_time": star.dim_time(base_tables["applications"])}
        tables = {name: write_table(dim, folder, name) for name, dim in dims.items()}
    facts = {
        "fact_application": star.fact_application(flat, tables, assigned),
        "fact_stage_event": star.fact_stage_event(base_tables["stage_events"]),
    }
    return tables | {name: write_table(fact, folder, name) for name, fact in facts.items()}


def require_keys(index: DataFrame) -> None:
    """Fail on a NULL or repeated candidate_id, from which all ids derive: then there are more rows than bits."""
    found = index.agg(F.sum("n").alias("rows"), F.sum(count_bits([F.col(b) for b in BITS])).alias("keys")).first()
    if found.rows and found.rows != found["keys"]:
        broken = found.rows - found["keys"]
        raise ValueError(f"{broken} of {found.rows} raw rows have no serial_no or repeat one")


def require_values(tables: dict[str, DataFrame]) -> None:
    """Fail on a NULL in a required column."""
    for name, df in tables.items():
        missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in CONSTRAINTS[name].required] or [F.lit(0)])
        broken = {column: n for column, n in missing.first().asDict().items() if n}
        if broken:
            raise ValueError(f"{name} has rows without a value: {broken}")


def write_tables(
    raw: DataFrame,
    folder: str,
    base: dt.date = BASE_DATE,
    check: bool = True,
    applied_on: Column | None = None,
    stages: Sequence[Stage] = STAGES,
    assigned: dict[str, Column] | None = None,
) -> dict[str, DataFrame]:
    """Load raw rows into base tables and star schema under ``folder``, in place of the last load.

    ``applied_on`` gives application dates instead of ``base`` plus serial_no days, ``stages`` the funnel, ``assigned``
    the recruiter, source and role keys of the fact. A NULL or repeated serial_no, or a NULL in a column that its
    table requires, stops the load with an error, and the tables of the load before stay; ``check=False`` skips those
    counts for rows known to be sound. The load before the last stays in the folder for whoever still reads it.

    Every big table is a projection of the raw rows, so no write shuffles them, but four of them read ``raw``, and
    so do the states of views. Where
    that is dear, as with text or a join, store it first and remove it afterwards::

        with scratch(spark):
            write_tables(written(raw, "raw"), folder)
    """
    spark = raw.sparkSession
    rows = journeys(raw, base, applied_on, stages)
    load = f"load-{uuid.uuid4().hex}"
    own = f"{folder}/{load}"
    try:
        tables = {name: write_table(df, own, name) for name, df in base_frames(rows, stages).items()}
        index = write_index(tables["candidates"], own)
        if check:
            require_keys(index)
            require_values(tables)
        tables |= write_star(tables, applications_flat(rows), own, assigned)
        write_states(rows, own, stages, assigned)
    except BaseException:
        remove(spark, own)
        raise
    commit(spark, folder, load)
    drop_old_loads(spark, folder)
    return tables
