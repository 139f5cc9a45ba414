"""Stage events: which stages an application enters, when it enters and when it leaves them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stagelight.functions.dates import add_days
from stagelight.functions.funnel import has_stage, name_bit
from stagelight.schemas import STAGES, TABLES, Stage


def ids_per_application(stages: Sequence[Stage]) -> int:
    """Ids need no global counter: each application has a power of ten of them, one for each rank."""
    return 10 ** len(str(len(stages)))


def _event(rank: int, stage: Stage, stages: Sequence[Stage], *exited: Column) -> Column:
    return F.struct(
        (F.col("application_id") * ids_per_application(stages) + rank).alias("stage_event_id"),
        F.lit(stage.name).alias("stage_name"),
        add_days(F.col("applied_at"), stage.days).alias("stage_entered_at"),
        *[e.alias("stage_exited_at") for e in exited],
    )


def _exploded(df: DataFrame, events: list[Column]) -> DataFrame:
    """One row per non-NULL event struct."""
    rows = df.select("application_id", F.explode(F.array(*events)).alias("e")).where(F.col("e").isNotNull())
    rows = rows.select("application_id", "e.*")
    return rows.select([c for c in TABLES["stage_events"].names if c in rows.columns])


def stage_events(journeys: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """One event per stage an application passes, from one scan and without a join."""
    bits = F.col("stage_bits")
    return _exploded(journeys, [F.when(has_stage(bits, k), _event(k + 1, s, stages)) for k, s in enumerate(stages)])


def closed_stage_events(journeys: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Stage events with their exits, without a shuffle.

    All stages of an application sit on its row at fixed offsets, so the exit of a stage is the entry of the first
    later stage that the row passes.
    """
    bits = F.col("stage_bits")
    ordered = sorted(enumerate(stages), key=lambda ranked: ranked[1].days)
    events = []
    for at, (k, stage) in enumerate(ordered):
        later = [F.when(has_stage(bits, j), add_days(F.col("applied_at"), s.days)) for j, s in ordered[at + 1 :]]
        exited = F.coalesce(*later, F.lit(None).cast("date"))
        events.append(F.when(has_stage(bits, k), _event(k + 1, stage, stages, exited)))
    return _exploded(journeys, events)


def stage_events_from_tables(
    applications: DataFrame, candidates: DataFrame, raw: DataFrame, stages: Sequence[Stage] = STAGES
) -> DataFrame:
    """Stage events from stored tables.

    What the rules read of candidates and raw rows comes to one row per candidate first; applications then meet it in
    a single join, which adaptive execution may split for a candidate that holds very many of them.
    """
    offers = raw.select(F.col("serial_no").alias("candidate_id"), "offer_history", "recruitment_status")
    known = {"candidates": candidates, "raw": offers}
    facts = None
    for table, rows in known.items():
        marked = rows.withColumn(f"in_{table}", F.lit(True))
        facts = marked if facts is None else facts.join(marked, "candidate_id", "full")
    rows = applications.select("application_id", "candidate_id", "applied_at").join(facts, "candidate_id", "left")
    events = []
    for rank, stage in enumerate(stages, 1):
        passed = stage.passes() if stage.reads == "applications" else F.col(f"in_{stage.reads}") & stage.passes()
        events.append(F.when(passed, _event(rank, stage, stages)))
    return _exploded(rows, events)


def stage_events_closed(events: DataFrame) -> DataFrame:
    """Set each event's exit to the next entry of the same application; NULL for the last one.

    Events of one day go by stage_event_id, NULL first: the day's last event leaves on the application's next day, the
    ones before it leave the same day. Copies of an event leave together. An event without a date has no exit, and
    rows without an application belong together.

    The events of an application and day are combined map-side to the day's last id, so that the window which looks
    for the next day holds a row per day at most, however many events an application has; joined back, adaptive
    execution may split a hot day.
    """
    columns = [c for c in TABLES["stage_events"].names if c != "stage_exited_at"]
    events = events.select(columns)
    days = events.where(F.col("stage_entered_at").isNotNull()).groupBy("application_id", "stage_entered_at")
    days = days.agg(F.max("stage_event_id").alias("last_id"))
    by_day = W.partitionBy("application_id").orderBy("stage_entered_at")
    days = days.select(
        F.col("application_id").alias("day_app"),
        F.col("stage_entered_at").alias("day"),
        "last_id",
        F.lead("stage_entered_at").over(by_day).alias("next_day"),
    )
    same_day = F.col("application_id").eqNullSafe(F.col("day_app")) & (F.col("stage_entered_at") == F.col("day"))
    is_last = F.col("stage_event_id").eqNullSafe(F.col("last_id"))
    exited = F.when(is_last, F.col("next_day")).otherwise(F.col("stage_entered_at"))
    return events.join(days, same_day, "left").select(*columns, exited.alias("stage_exited_at"))


def reached_stages(events: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """One row per application with the stages among its events as bits.

    Combined map-side, so repeated events and hot applications shrink before the shuffle, and the result can be
    joined on application_id without another one.
    """
    known = events.where(F.col("application_id").isNotNull())
    return known.groupBy("application_id").agg(F.bit_or(name_bit(F.col("stage_name"), stages)).alias("stage_bits"))
