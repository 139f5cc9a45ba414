"""Analytic results.

Funnel results work on rows of application grain that carry ``stage_bits``: ``journeys`` straight from raw rows, or
``reached_stages`` of any event table. An application counts once per stage however many events it has, so sums over
bits are exact distinct counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.functions.dates import month_text
from stagelight.functions.funnel import band_rank, has_stage, name_bit
from stagelight.functions.funnel import score_band as band_of
from stagelight.functions.rates import nonzero, rate, rounded_ratio
from stagelight.operators.stages import reached_stages
from stagelight.schemas import STAGES, Stage


def _stage_sums(stages: Sequence[Stage]) -> list[Column]:
    """Applications per stage, one column each, named after the stage in lower case."""
    return [F.count_if(has_stage(F.col("stage_bits"), k)).alias(s.name.lower()) for k, s in enumerate(stages)]


def _stage_rows(sums: DataFrame, keep: Sequence[str], stages: Sequence[Stage]) -> DataFrame:
    """Turn the columns of ``_stage_sums`` into rows, in funnel order, leaving out stages without applications."""
    pairs = [F.struct(F.lit(s.name).alias("stage_name"), F.col(s.name.lower()).alias("apps")) for s in stages]
    return sums.select(*keep, F.inline(F.array(*pairs))).where(F.col("apps") > 0)


def funnel_counts(reached: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Applications per known stage, in funnel order (one aggregated row, unfolded in that order).

    Counts rows: application ids must be unique, as in ``reached_stages`` of any events and ``journeys`` of sound rows.
    """
    return funnel_of_sums(reached.agg(*_stage_sums(stages)), stages)


def funnel_of_sums(sums: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """The same from one row of applications per stage, a column each in lower case."""
    return _stage_rows(sums, [], stages)


def stage_counts_unfiltered(events: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Distinct applications for every stage name that occurs, known stages in funnel order after all others.

    The known stages of an application shrink to one row of bits before the shuffle; only a name outside the funnel
    makes a row of its own.
    """
    application, bit = F.col("application_id"), name_bit(F.col("stage_name"), stages)
    other = F.when(bit == 0, F.struct("stage_name")).alias("other")
    groups = events.groupBy(application, other).agg(F.bit_or(bit).alias("stage_bits"))
    counts = [F.count(application).alias("apps_other")]
    for k, _ in enumerate(stages):
        has = has_stage(F.col("stage_bits"), k)
        counts += [F.count(F.when(has, application)).alias(f"apps_{k}"), F.bool_or(has).alias(f"seen_{k}")]
    totals = groups.groupBy("other").agg(*counts)
    rows = [(F.lit(s.name), F.col(f"apps_{k}"), F.col(f"seen_{k}"), k + 1) for k, s in enumerate(stages)]
    rows.append((F.col("other.stage_name"), F.col("apps_other"), F.col("other").isNotNull(), 0))
    names = ["stage_name", "apps", "seen", "rank"]
    unfolded = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]
    found = totals.select(F.inline(F.array(*unfolded))).where("seen")
    return found.orderBy("rank", "stage_name").select("stage_name", "apps")


def conversion_overall(reached: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """One row: applications per stage, the rate of each step, and the rate from first to last stage.

    Counts rows: application ids must be unique, as for ``funnel_counts``.
    """
    return overall_of_sums(reached.agg(*_stage_sums(stages)), stages)


def overall_of_sums(sums: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    names = [s.name.lower() for s in stages]
    counts = sums.select([nonzero(F.col(n)).alias(n) for n in names])
    steps = [rate(F.col(b), F.col(a)).alias(f"conv_{a}_to_{b}") for a, b in zip(names, names[1:])]
    return counts.select(*names, *steps, rate(F.col(names[-1]), F.col(names[0])).alias("conv_overall"))


def stage_durations(closed_events: DataFrame) -> DataFrame:
    """Mean days in each stage over events that have an exit, longest first."""
    days = F.datediff("stage_exited_at", "stage_entered_at")
    closed = closed_events.where(F.col("stage_exited_at").isNotNull()).groupBy("stage_name")
    return durations_of_sums(closed.agg(F.sum(days).alias("days"), F.count(days).alias("n")))


def durations_of_sums(sums: DataFrame) -> DataFrame:
    """The same from the days and number of events per stage."""
    means = sums.select("stage_name", rounded_ratio(F.col("days"), F.col("n"), 2).alias("avg_days_in_stage"))
    return means.orderBy(F.desc("avg_days_in_stage"), "stage_name")


def _conversion(groups: DataFrame, column: str, apps: Column, hires: Column, rate_name: str) -> DataFrame:
    return conversion_of_sums(groups.groupBy(column).agg(apps.alias("apps"), hires.alias("hires")), rate_name)


def conversion_of_sums(sums: DataFrame, rate_name: str = "conversion_rate") -> DataFrame:
    """Applications and hires per group with their rate."""
    return sums.withColumn(rate_name, rate(F.col("hires"), F.col("apps")))


def _conversion_of_rows(flat: DataFrame, column: str, rate_name: str = "conversion_rate") -> DataFrame:
    return _conversion(flat, column, F.count(F.lit(1)), F.sum("hired"), rate_name)


def _conversion_of_tables(applications: DataFrame, candidates: DataFrame, column: str) -> DataFrame:
    """Combine applications per candidate before the join, so a hot candidate is one row in it."""
    per_candidate = applications.groupBy("candidate_id").agg(F.count(F.lit(1)).alias("n"), F.sum("hired").alias("h"))
    joined = per_candidate.join(candidates.select("candidate_id", column), "candidate_id")
    return _conversion(joined, column, F.sum("n"), F.sum("h"), "conversion_rate")


def conversion_by_education(flat: DataFrame) -> DataFrame:
    """Applications, hires and hire rate per education level; NULL is a group of its own."""
    return _conversion_of_rows(flat, "education_level")


def conversion_by_location(flat: DataFrame) -> DataFrame:
    """Applications, hires and hire rate per location; NULL is a group of its own."""
    return _conversion_of_rows(flat, "location")


def conversion_by_education_from_tables(applications: DataFrame, candidates: DataFrame) -> DataFrame:
    return _conversion_of_tables(applications, candidates, "education_level")


def conversion_by_location_from_tables(applications: DataFrame, candidates: DataFrame) -> DataFrame:
    return _conversion_of_tables(applications, candidates, "location")


# The columns of the two record-level views.
FLAT_COLUMNS = [
    "application_id", "candidate_id", "applied_at", "hired", "gender", "education_level",
    "years_experience", "python_exp", "internship", "score", "location", "salary_band",
]
FLAT_STAR_COLUMNS = [
    "application_id", "candidate_id", "applied_date_key", "hired", "years_experience", "score", "salary_band",
    "education_level", "location", "python_exp", "internship", "recruiter_name", "source_name", "role_name",
]


def applications_flat(journeys: DataFrame) -> DataFrame:
    """Record-level view of applications with their candidate, from one scan."""
    return journeys.select(FLAT_COLUMNS)


def applications_flat_from_tables(applications: DataFrame, candidates: DataFrame) -> DataFrame:
    """The same from stored tables: one join, which adaptive execution may split on a hot candidate."""
    return applications.join(candidates, "candidate_id").select(FLAT_COLUMNS)


def applications_flat_star(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Record-level view of the fact with names instead of keys.

    Dimension joins carry no hint: a dimension is broadcast as long as its known size is under the session's limit.
    """
    rows = fact
    for name in ["education", "location", "python", "internship", "recruiter", "source", "role"]:
        rows = rows.join(dims[f"dim_{name}"], f"{name}_key", "left")
    rows = rows.withColumnsRenamed({"has_python": "python_exp", "has_internship": "internship"})
    return rows.select(FLAT_STAR_COLUMNS)


def with_reached(fact: DataFrame, fact_stage_event: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """The application fact with the stages of each application as bits; applications without events drop out.

    Both sides meet with one row per application, so no key is hot, and the reduced events need no second shuffle.
    """
    return fact.join(reached_stages(fact_stage_event, stages), "application_id")


SLICE_KEYS = ["role_key", "source_key", "recruiter_key"]


def funnel_by_slice(
    reached_fact: DataFrame, dims: dict[str, DataFrame], stages: Sequence[Stage] = STAGES
) -> DataFrame:
    """Applications per role, source, recruiter and stage: aggregate on the keys, then look the names up."""
    return slices_of_sums(reached_fact.groupBy(SLICE_KEYS).agg(*_stage_sums(stages)), dims, stages)


def slices_of_sums(sums: DataFrame, dims: dict[str, DataFrame], stages: Sequence[Stage] = STAGES) -> DataFrame:
    rows = _stage_rows(sums, SLICE_KEYS, stages)
    for name in ["role", "source", "recruiter"]:
        rows = rows.join(dims[f"dim_{name}"], f"{name}_key")
    return rows.select("role_name", "source_name", "recruiter_name", "stage_name", "apps")


def cohort_conversion(reached_fact: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Applications per month of application and stage, stages as columns; NULL where a stage has none."""
    by_month = reached_fact.groupBy(month_text(F.col("applied_date_key")).alias("cohort_month"))
    return cohorts_of_sums(by_month.agg(*_stage_sums(stages)), stages)


def cohorts_of_sums(sums: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    names = [s.name.lower() for s in stages]
    return sums.select("cohort_month", *[nonzero(F.col(n)).alias(n) for n in names]).orderBy("cohort_month")


def score_band(fact: DataFrame) -> DataFrame:
    """Applications, hires and hire rate per score band, in band order. A NULL score counts as 'Very High'."""
    banded = fact.select(band_of(F.col("score")).alias("score_band"), "hired")
    return in_band_order(_conversion_of_rows(banded, "score_band", "hire_rate"))


def in_band_order(bands: DataFrame) -> DataFrame:
    return bands.orderBy(band_rank(F.col("score_band")))
