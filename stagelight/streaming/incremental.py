"""Incremental load with Structured Streaming."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession

from stagelight.operators.load import journeys
from stagelight.operators.quality import constraint_violations
from stagelight.schemas import BASE_DATE, CONSTRAINTS, STAGES, Stage
from stagelight.sources.raw import rename_raw, text_reader, typed
from stagelight.sources.warehouse import base_frames, conformed, read_table


def load_new_files(
    spark: SparkSession,
    source: str,
    folder: str,
    base: dt.date = BASE_DATE,
    applied_on: Column | None = None,
    stages: Sequence[Stage] = STAGES,
    extra: Sequence[str] = (),
) -> int:
    """Append the raw CSV files under ``source`` that no earlier call has loaded to the base tables in ``folder``.

    The same projections as in the batch load, without state or shuffle; ``extra`` names further columns of the files,
    for ``applied_on`` and ``stages`` to use. Each table keeps a checkpoint of the files it has taken, so running the
    load again, or after a failure, adds no row twice. A folder loaded this way should get no batch load, whose tables
    would be read instead.

    An application that arrives in two different files is kept twice, as the raw rows say. Returns how many candidates
    repeat an id or have none: 0 as long as ids are unique, which joins and counts over the tables rely on.
    """
    text = text_reader(spark.readStream, "csv", extra).load(source)
    rows = journeys(typed(rename_raw(text, extra)), base, applied_on, stages)
    for name, df in base_frames(rows, stages).items():
        query = (
            conformed(df, name)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{folder}/_loaded/{name}")
            .trigger(availableNow=True)
            .start(f"{folder}/{name}")
        )
        query.awaitTermination()
    candidates = {"candidates": read_table(spark, folder, "candidates")}
    return constraint_violations(candidates, {"candidates": CONSTRAINTS["candidates"]}).first().violations
