"""From raw rows to candidates and applications."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.functions.dates import days_after
from stagelight.functions.funnel import one_if, passed_bits
from stagelight.schemas import BASE_DATE, STAGES, TABLES, Stage


def raw_row_count(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("raw_rows"))


def _candidate_columns() -> list[Column]:
    return [
        F.col("serial_no").alias("candidate_id"),
        F.col("gender"),
        F.col("education").alias("education_level"),
        F.col("experience_years").alias("years_experience"),
        one_if(F.col("python_exp"), "Yes").alias("python_exp"),
        one_if(F.col("internship"), "Yes").alias("internship"),
        F.col("score"),
        F.col("location"),
        F.col("salary_band"),
    ]


def _application_columns(base: dt.date, applied_on: Column | None) -> list[Column]:
    applied_at = days_after(base, F.col("serial_no")) if applied_on is None else applied_on.cast("date")
    return [
        F.col("serial_no").alias("application_id"),
        applied_at.alias("applied_at"),
        one_if(F.col("recruitment_status"), "Y").alias("hired"),
    ]


def candidates(raw: DataFrame) -> DataFrame:
    """One candidate per raw row; a Yes/No column is 1 for 'Yes' and 0 for anything else."""
    return raw.select(_candidate_columns())


def applications(raw: DataFrame, base: dt.date = BASE_DATE, applied_on: Column | None = None) -> DataFrame:
    """One application per raw row, dated ``base`` plus serial_no days unless ``applied_on`` gives the date.

    application_id equals candidate_id: the two are one to one, and a running number would need a global sort.
    """
    columns = _application_columns(base, applied_on)
    return raw.select(*columns, F.col("serial_no").alias("candidate_id")).select(TABLES["applications"].names)


def journeys(
    raw: DataFrame,
    base: dt.date = BASE_DATE,
    applied_on: Column | None = None,
    stages: Sequence[Stage] = STAGES,
) -> DataFrame:
    """Everything known of an application on one row: candidate, application, and the stages it passes as bits.

    A raw row holds all of it, so this is a projection: whatever is built on it needs no join of candidates,
    applications and events, and counting applications per stage needs no distinct. serial_no must be unique, as the
    primary key of candidates declares.
    """
    extra = [F.col("offer_history"), F.col("recruitment_status")]
    rows = raw.select(*_application_columns(base, applied_on), *_candidate_columns(), *extra)
    return rows.withColumn("stage_bits", passed_bits(stages)).drop("offer_history", "recruitment_status")


def base_table_counts(candidates: DataFrame, applications: DataFrame) -> DataFrame:
    """Row counts of the two tables, one row each."""

    def count(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))

    return count("candidates", candidates).unionByName(count("applications", applications))
