"""Mergeable states of the aggregate views: what a load adds to each of them.

A state row belongs to a view and a group of up to three keys and holds sums of whole numbers: applications per stage,
applications and hires, or days and events. States of loads add up, since every application is in one load only, and
rates are taken from the sums at the end; so a view over any number of loads reads a few rows of each, and never the
events or applications they came from.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.functions.dates import month_text
from stagelight.functions.funnel import has_stage, score_band
from stagelight.operators import marts, star
from stagelight.operators.stages import closed_stage_events
from stagelight.schemas import STAGES, Stage

KEYS = ["key_1", "key_2", "key_3"]


def _sums(stages: Sequence[Stage]) -> list[str]:
    return [f"sum_{k}" for k in range(max(2, len(stages)))]


def schema(stages: Sequence[Stage] = STAGES) -> str:
    columns = [f"{name} string" for name in ["view", *KEYS]] + [f"{name} long" for name in _sums(stages)]
    return ", ".join(columns)


def load_states(
    rows: DataFrame, stages: Sequence[Stage] = STAGES, assigned: dict[str, Column] | None = None
) -> DataFrame:
    """The states of the journeys of one load. A row goes to the groups it counts in and is combined in the task; the
    shuffle moves a row per group and task."""
    keyed = star.with_assigned_keys(rows, assigned)
    month = month_text(F.col("applied_date_key"))
    by_stage = {"funnel": [], "slice": [F.col(k) for k in marts.SLICE_KEYS], "month": [month]}
    by_hire = {
        "education": [F.col("education_level")],
        "location": [F.col("location")],
        "band": [score_band(F.col("score"))],
    }

    def group(view: str, keys: list[Column], is_stage: bool) -> Column:
        padded = [*(k.cast("string") for k in keys), *[F.lit(None).cast("string")] * (len(KEYS) - len(keys))]
        names = [k.alias(name) for k, name in zip(padded, KEYS, strict=True)]
        row = F.struct(F.lit(view).alias("view"), *names, F.lit(is_stage).alias("by_stage"))
        return F.when(F.col("stage_bits") != 0, row) if is_stage else row

    groups = [group(view, keys, True) for view, keys in by_stage.items()]
    groups += [group(view, keys, False) for view, keys in by_hire.items()]
    folded = keyed.select("stage_bits", "hired", F.explode(F.array(*groups)).alias("g")).where(F.col("g").isNotNull())
    folded = folded.select("stage_bits", "hired", "g.*")
    one, hired = F.lit(1).cast("long"), F.col("hired").cast("long")
    aggregates = []
    for k, name in enumerate(_sums(stages)):
        passed = has_stage(F.col("stage_bits"), k).cast("long") if k < len(stages) else F.lit(0).cast("long")
        other = one if k == 0 else hired if k == 1 else F.lit(0).cast("long")
        aggregates.append(F.sum(F.when(F.col("by_stage"), passed).otherwise(other)).alias(name))
    states = folded.groupBy("view", *KEYS).agg(*aggregates)
    return states.unionByName(_duration_states(rows, stages))


def _duration_states(rows: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    days = F.datediff("stage_exited_at", "stage_entered_at").cast("long")
    closed = closed_stage_events(rows, stages).where(F.col("stage_exited_at").isNotNull())
    spent = closed.groupBy("stage_name").agg(F.sum(days).alias("sum_0"), F.count(days).alias("sum_1"))
    rest = [F.lit(0).cast("long").alias(name) for name in _sums(stages)[2:]]
    none = [F.lit(None).cast("string").alias(name) for name in KEYS[1:]]
    return spent.select(
        F.lit("duration").alias("view"), F.col("stage_name").alias(KEYS[0]), *none, "sum_0", "sum_1", *rest
    )


def view_frames(
    states: DataFrame, dims: Mapping[str, DataFrame], stages: Sequence[Stage] = STAGES
) -> dict[str, DataFrame]:
    """The aggregate views from the states of all loads, under the names of ``sources.views``."""
    added = states.groupBy("view", *KEYS).agg(*[F.sum(name).alias(name) for name in _sums(stages)])

    def of(view: str, keys: list[str], sums: list[str]) -> DataFrame:
        own = added.where(F.col("view") == view)
        named = [F.col(k).alias(name) for k, name in zip(KEYS, keys)]
        return own.select(*named, *[F.col(k).alias(name) for k, name in zip(_sums(stages), sums)])

    names = [s.name.lower() for s in stages]
    whole = of("funnel", [], names).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])  # a row if none is
    slices = of("slice", marts.SLICE_KEYS, names)
    slices = slices.withColumns({k: F.col(k).cast("int") for k in marts.SLICE_KEYS})
    hires = ["apps", "hires"]
    durations = marts.durations_of_sums(of("duration", ["stage_name"], ["days", "n"]))
    return {
        "v_funnel_counts": marts.funnel_of_sums(whole, stages),
        "v_conversion_overall": marts.overall_of_sums(whole, stages),
        "v_stage_durations": durations,
        "v_stage_durations_star": durations,
        "v_conversion_by_edu": marts.conversion_of_sums(of("education", ["education_level"], hires)),
        "v_conversion_by_location": marts.conversion_of_sums(of("location", ["location"], hires)),
        "v_funnel_by_slice": marts.slices_of_sums(slices, dict(dims), stages),
        "v_cohort_conversion": marts.cohorts_of_sums(of("month", ["cohort_month"], names), stages),
        "v_score_band": marts.in_band_order(
            marts.conversion_of_sums(of("band", ["score_band"], hires), "hire_rate")
        ),
    }
