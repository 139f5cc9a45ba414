"""Star schema: dimensions and facts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.functions.dates import week_of_year
from stagelight.plans.keys import numbered
from stagelight.plans.shared import written
from stagelight.schemas import RECRUITERS, ROLES, SOURCES, TABLES

CALENDAR_BLOCK = 4096
ATTRIBUTES = {"dim_education": "education_level", "dim_location": "location"}
#: Dimensions whose members are given.
LISTED = ["dim_python", "dim_internship", "dim_recruiter", "dim_source", "dim_role"]


def _values(candidates: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The distinct non-NULL values of some columns, from one scan."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]
    return candidates.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()


def attribute_dims(candidates: DataFrame, names: Sequence[str] = tuple(ATTRIBUTES)) -> dict[str, DataFrame]:
    """Dimensions of the distinct non-NULL values of candidate columns, numbered in order of value.

    Each is written to the shared folder, so that joins know its real size; one scan of candidates serves all of them.
    """
    columns = {ATTRIBUTES[name]: name for name in names}
    keyed = numbered(_values(candidates, columns))
    return {name: written(_members(keyed, name), name) for name in names}


def _members(keyed: DataFrame, name: str) -> DataFrame:
    key, value = TABLES[name].names
    own = keyed.where(F.col("column_name") == value)
    return own.select(F.col("key").alias(key), F.col("value").alias(value))


def new_members(candidates: DataFrame, stored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What candidates add to stored attribute dimensions: members that are not there yet, numbered on from the highest
    stored key in order of value.

    Stored members keep their keys, there is no gap, and candidates that were added before add nothing. One scan of
    candidates serves all of ``stored``. New members are range-partitioned to be numbered; the highest key is an
    aggregate of a row per dimension.
    """
    columns = {ATTRIBUTES[name]: name for name in stored}
    known = highest = None
    for column, name in columns.items():
        key, value = TABLES[name].names
        rows = stored[name].select(F.lit(column).alias("column_name"), F.col(value).alias("value"), F.col(key).alias("key"))
        known = rows if known is None else known.unionByName(rows)
    highest = known.groupBy("column_name").agg(F.max("key").alias("highest"))
    fresh = _values(candidates, columns).join(known, ["column_name", "value"], "left_anti")
    keyed = numbered(fresh).join(highest, "column_name", "left")
    keyed = keyed.withColumn("key", F.col("key") + F.coalesce("highest", F.lit(0)))
    return {name: written(_members(keyed, name), name) for name in stored}


def dim_education(candidates: DataFrame) -> DataFrame:
    return attribute_dims(candidates, ["dim_education"])["dim_education"]


def dim_location(candidates: DataFrame) -> DataFrame:
    return attribute_dims(candidates, ["dim_location"])["dim_location"]


def _listed(spark: SparkSession, table: str, values: Sequence) -> DataFrame:
    """A dimension of given values, keyed 1..n in the order given."""
    key, value = TABLES[table].names
    rows = spark.range(0, 1, 1, 1).select(F.posexplode(F.array(*[F.lit(v) for v in values])))
    return rows.select((F.col("pos") + 1).alias(key), F.col("col").alias(value))


def dim_python(spark: SparkSession) -> DataFrame:
    return _listed(spark, "dim_python", [0, 1])


def dim_internship(spark: SparkSession) -> DataFrame:
    return _listed(spark, "dim_internship", [0, 1])


def dim_recruiter(spark: SparkSession, names: Sequence[str] = RECRUITERS) -> DataFrame:
    return _listed(spark, "dim_recruiter", names)


def dim_source(spark: SparkSession, names: Sequence[str] = SOURCES) -> DataFrame:
    return _listed(spark, "dim_source", names)


def dim_role(spark: SparkSession, names: Sequence[str] = ROLES) -> DataFrame:
    return _listed(spark, "dim_role", names)


def listed_dims(spark: SparkSession) -> dict[str, DataFrame]:
    """The dimensions that do not depend on data."""
    makers = [dim_python, dim_internship, dim_recruiter, dim_source, dim_role]
    return {make.__name__: make(spark) for make in makers}


def dimensions(candidates: DataFrame) -> dict[str, DataFrame]:
    """All dimensions but the calendar."""
    return attribute_dims(candidates) | listed_dims(candidates.sparkSession)


def dim_time(applications: DataFrame) -> DataFrame:
    """One row per day from the first to the last application date; no rows without a date.

    The range is complete however long it is. It is unfolded in two steps, blocks of days and then days, so that no
    row holds a long range; the blocks are dealt to all tasks.
    """
    return _calendar(_span(applications, "applied_at"))


def _span(rows: DataFrame, column: str) -> DataFrame:
    """First and last day of a date column as day numbers; one row."""
    return rows.agg(
        F.unix_date(F.min(column)).cast("long").alias("first"), F.unix_date(F.max(column)).cast("long").alias("last")
    )


def new_days(applications: DataFrame, stored: DataFrame) -> DataFrame:
    """The days that applications add to a stored calendar: before its first day and after its last, without a gap."""
    own = _span(applications, "applied_at").select(F.lit(1).alias("one"), "first", "last")
    old = _span(stored, "date_key").select(F.lit(1).alias("one"), F.col("first").alias("begin"), F.col("last").alias("end"))
    both = own.join(old, "one")  # one row each
    before = F.struct(F.col("first"), F.coalesce(F.col("begin") - 1, "last").alias("last"))
    after = F.struct((F.col("end") + 1).alias("first"), F.col("last"))
    spans = both.select(F.inline(F.array(before, after))).where(F.col("first") <= F.col("last"))
    return _calendar(spans)


def _calendar(spans: DataFrame) -> DataFrame:
    """The days of spans of day numbers, first to last."""
    known = spans.where(F.col("first").isNotNull())
    blocks = known.select("last", F.explode(F.sequence("first", "last", F.lit(CALENDAR_BLOCK))).alias("begin"))
    end = F.least(F.col("begin") + CALENDAR_BLOCK - 1, F.col("last"))
    days = blocks.repartition("begin").select(F.explode(F.sequence("begin", end)).alias("number"))
    days = days.select(F.date_from_unix_date(F.col("number").cast("int")).alias("date_key"))
    day = F.col("date_key")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        week_of_year(day).alias("week"),
    )


def assigned_keys() -> dict[str, Column]:
    """Recruiter, source and role by default: all three cycle with candidate_id, so they always agree."""
    cycle = (F.col("candidate_id") % 4 + 1).cast("int")
    return {"recruiter_key": cycle, "source_key": cycle, "role_key": cycle}


def fact_application(
    flat: DataFrame, dims: dict[str, DataFrame], assigned: dict[str, Column] | None = None
) -> DataFrame:
    """Application fact from record-level rows; a value without a match in its dimension gets a NULL key.

    ``flat`` is ``applications_flat`` or ``journeys`` (one scan), or ``applications_flat_from_tables``.
    """
    rows = flat
    lookups = {
        "dim_education": "education_level",
        "dim_location": "location",
        "dim_python": "python_exp",
        "dim_internship": "internship",
    }
    for table, column in lookups.items():
        key, value = TABLES[table].names
        dim = dims[table].select(F.col(key), F.col(value).alias(column))
        rows = rows.join(dim, column, "left")
    rows = rows.withColumns(assigned or assigned_keys()).withColumnRenamed("applied_at", "applied_date_key")
    return rows.select(TABLES["fact_application"].names)


def with_assigned_keys(journeys: DataFrame, assigned: dict[str, Column] | None = None) -> DataFrame:
    """Journeys under the fact's names for what funnel results need: date key, assigned keys and stage bits."""
    return journeys.withColumns(assigned or assigned_keys()).withColumnRenamed("applied_at", "applied_date_key")


def fact_stage_event(closed_events: DataFrame) -> DataFrame:
    return closed_events.select(TABLES["fact_stage_event"].names)
