"""Stored events whose exits are updated in place of being derived anew: only buckets that a batch touches are rewritten.

An event lies in a bucket by the hash of its application, so an exit depends on events of its own bucket alone. A batch
reads the buckets that its events fall into, sets the exits in them, and writes these buckets again under a version of
its own. One line in ``_changes`` then makes that version the one that is read for them; other buckets keep their files.
A batch that stops half way changes nothing, and one that is offered again is known by its name.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.operators.stages import stage_events_closed
from stagelight.plans.shared import remove, scratch, written
from stagelight.schemas import TABLES

CHANGES = "number long, version string, batch string, buckets int, touched array<int>"


class Change(NamedTuple):
    """A batch that came to its end: its version, and the buckets it wrote of ``buckets`` in all."""

    number: int
    version: str
    batch: str
    buckets: int
    touched: tuple[int, ...]


def changes(spark: SparkSession, folder: str) -> list[Change]:
    """Every change, oldest first. A line per batch."""
    try:
        rows = spark.read.schema(CHANGES).json(f"{folder}/_changes").collect()
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return []
    return sorted(Change(r.number, r.version, r.batch, r.buckets, tuple(r.touched)) for r in rows)


def current_versions(done: list[Change]) -> dict[int, str]:
    """The version to read of each bucket that has events."""
    return {bucket: change.version for change in done for bucket in change.touched}


def _read(spark: SparkSession, folder: str, versions: dict[int, str]) -> DataFrame:
    schema = TABLES["stage_events"]
    if not versions:
        return spark.createDataFrame([], schema)
    places = [f"{folder}/{version}/bucket={bucket}" for bucket, version in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*places)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """All stored events with their exits, as of the last change."""
    return _read(spark, folder, current_versions(changes(spark, folder)))


def _in_buckets(events: DataFrame, buckets: int) -> DataFrame:
    """Events with the bucket of their application; those without one share a bucket."""
    return events.withColumn("bucket", F.pmod(F.hash("application_id"), F.lit(buckets)))


def merge_events(events: DataFrame, folder: str, batch: str, buckets: int = 64) -> bool:
    """Add events to the stored ones and update the exits they change; False if the batch was taken before.

    The stored events are ``stage_events_closed`` of all batches, in whatever order they come, repeated events and events
    without an application or a date included. Exits that ``events`` may carry are set anew. ``buckets`` counts when the
    folder is empty and stays afterwards: as many as keep a bucket near a gigabyte. A bucket is written by as many tasks
    as it needs, so an application with very many events delays no single one. One batch at a time may be merged.
    """
    spark = events.sparkSession
    done = changes(spark, folder)
    if any(change.batch == batch for change in done):
        return False
    if done:
        buckets = done[0].buckets
    version = f"version-{uuid.uuid4().hex}"
    columns = [c for c in TABLES["stage_events"].names if c != "stage_exited_at"]
    try:
        with scratch(spark):
            new = written(_in_buckets(events.select(columns), buckets), "events")
            touched = sorted(row.bucket for row in new.select("bucket").distinct().collect())  # ``buckets`` at most
            if touched:
                kept = {b: v for b, v in current_versions(done).items() if b in set(touched)}
                rows = new.select(columns).unionByName(_read(spark, folder, kept).select(columns))
                closed = _in_buckets(stage_events_closed(rows), buckets)
                closed = closed.select(*TABLES["stage_events"].names, "bucket").hint("rebalance", F.col("bucket"))
                closed.write.partitionBy("bucket").parquet(f"{folder}/{version}")
    except BaseException:
        remove(spark, f"{folder}/{version}")
        raise
    number = done[-1].number + 1 if done else 1
    line = spark.createDataFrame([(number, version, batch, buckets, touched)], CHANGES).coalesce(1)
    line.write.mode("append").json(f"{folder}/_changes")
    return True


def drop_old_versions(spark: SparkSession, folder: str) -> int:
    """Remove bucket files that a later change replaced; returns how many buckets of a version went.

    Whoever still reads the events as they were needs these files, so nothing calls this by itself.
    """
    done = changes(spark, folder)
    now = current_versions(done)
    old = [(c.version, bucket) for c in done for bucket in c.touched if now[bucket] != c.version]
    for version, bucket in old:
        remove(spark, f"{folder}/{version}/bucket={bucket}")
    return len(old)
