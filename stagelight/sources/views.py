"""The stored tables and their results as SQL views of a session."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from stagelight.operators import marts
from stagelight.operators.stages import reached_stages
from stagelight.operators.states import view_frames
from stagelight.schemas import STAGES, Stage


def result_frames(tables: Mapping[str, DataFrame], stages: Sequence[Stage] = STAGES) -> dict[str, DataFrame]:
    """Every result over stored tables, by view name. Two results come from base tables and from the star as well."""
    base = tables["applications"], tables["candidates"]
    fact, fact_events = tables["fact_application"], tables["fact_stage_event"]
    reached = reached_stages(tables["stage_events"], stages)
    reached_fact = marts.with_reached(fact, fact_events, stages)
    return {
        "v_applications_flat": marts.applications_flat_from_tables(*base),
        "v_applications_flat_star": marts.applications_flat_star(fact, tables),
        "v_funnel_counts": marts.funnel_counts(reached, stages),
        "v_conversion_overall": marts.conversion_overall(reached, stages),
        "v_stage_durations": marts.stage_durations(tables["stage_events"]),
        "v_stage_durations_star": marts.stage_durations(fact_events),
        "v_conversion_by_edu": marts.conversion_by_education_from_tables(*base),
        "v_conversion_by_location": marts.conversion_by_location_from_tables(*base),
        "v_funnel_by_slice": marts.funnel_by_slice(reached_fact, tables, stages),
        "v_cohort_conversion": marts.cohort_conversion(reached_fact, stages),
        "v_score_band": marts.score_band(fact),
    }


def create_views(
    tables: Mapping[str, DataFrame], stages: Sequence[Stage] = STAGES, states: DataFrame | None = None
) -> list[str]:
    """Create or replace a temporary view per table and result; returns their names.

    A view is a plan, not data: what a query over it selects and filters still reaches the Parquet scan. With the stored
    ``states`` of all loads (``warehouse.read_states``) the aggregate views add those up, and read neither events nor
    applications.
    """
    frames = {**tables, **result_frames(tables, stages)}
    if states is not None:
        frames |= view_frames(states, tables, stages)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
