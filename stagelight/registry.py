"""Every operator as a query over the orders and customer tables.

A plain name is the operator on journeys, that is straight from raw rows. A name ending in ``_from_...`` is the same
result through the operators that work on stored tables; both have the same oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.operators import key_checks, load, marts, quality, stages, star, states
from stagelight.plans.bitmaps import BITS, count_bits, key_index
from stagelight.plans.shared import shared_path, written
from stagelight.schemas import TABLES
from stagelight.sources import batches, bucketed, event_store, warehouse
from stagelight.sources.export import export_results
from stagelight.sources.orders import raw_from_orders

Query = Callable[[SparkSession, str], DataFrame]


def _of_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(raw_from_orders(spark, sf_dir))


def _of_journeys(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _of_raw(lambda raw: build(load.journeys(raw)))


def _of_base(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return _of_raw(lambda raw: build(load.applications(raw), load.candidates(raw)))


def _of_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _of_journeys(lambda rows: build(stages.stage_events(rows)))


def _of_closed(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _of_journeys(lambda rows: build(stages.closed_stage_events(rows)))


def _of_keyed(build: Callable[[DataFrame, dict[str, DataFrame]], DataFrame]) -> Query:
    """Journeys with assigned keys, and the dimensions that need no data."""
    return _of_journeys(lambda rows: build(star.with_assigned_keys(rows), star.listed_dims(rows.sparkSession)))


def _fact(raw: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    dims = star.dimensions(load.candidates(raw))
    return star.fact_application(marts.applications_flat(load.journeys(raw)), dims), dims


def _of_facts(build: Callable[[DataFrame, DataFrame, dict[str, DataFrame]], DataFrame]) -> Query:
    """Application fact, stage event fact and dimensions."""

    def run(raw: DataFrame) -> DataFrame:
        fact, dims = _fact(raw)
        return build(fact, star.fact_stage_event(stages.closed_stage_events(load.journeys(raw))), dims)

    return _of_raw(run)


def _used_members(name: str) -> Query:
    """A listed dimension with the applications of each member."""
    key = {"dim_python": "python_exp", "dim_internship": "internship"}

    def run(rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
        dim = dims[name]
        own_key, value = dim.columns
        column, joined_on = (key[name], value) if name in key else (own_key, own_key)
        used = rows.groupBy(F.col(column).alias(joined_on)).agg(F.count(F.lit(1)).alias("apps"))
        return dim.join(used, joined_on, "left").select(own_key, value, F.coalesce("apps", F.lit(0)).alias("apps"))

    return _of_keyed(run)


def _fact_application_from_tables(raw: DataFrame) -> DataFrame:
    candidates = load.candidates(raw)
    flat = marts.applications_flat_from_tables(load.applications(raw), candidates)
    return star.fact_application(flat, star.dimensions(candidates))


def _stage_events_from_tables(raw: DataFrame) -> DataFrame:
    return stages.stage_events_from_tables(load.applications(raw), load.candidates(raw), raw)


def _cohort_by_order_date(raw: DataFrame) -> DataFrame:
    return marts.cohort_conversion(star.with_assigned_keys(load.journeys(raw, applied_on=F.col("ordered_on"))))


def _export_csv(raw: DataFrame) -> DataFrame:
    """The four exports, written and read back as lines."""
    spark, rows = raw.sparkSession, load.journeys(raw)
    exports = {
        "funnel_counts": marts.funnel_counts(rows),
        "stage_durations": marts.stage_durations(stages.closed_stage_events(rows)),
        "conversion_by_education": marts.conversion_by_education(rows).orderBy("education_level"),
        "conversion_by_location": marts.conversion_by_location(rows).orderBy("location"),
    }
    folder = shared_path(spark, "exports")
    export_results(exports, folder)
    lines = spark.read.text([f"{folder}/{name}.csv" for name in exports])
    name = F.regexp_extract(F.input_file_name(), r"/([a-z_]+)\.csv/", 1)
    return lines.select(name.alias("export_name"), F.col("value").alias("line"))


def _constraint_violations(raw: DataFrame, check=quality.constraint_violations) -> DataFrame:
    """All tables of a load, from rows that are stored once."""
    rows = written(load.journeys(raw), "journeys")
    candidates = rows.select(TABLES["candidates"].names)
    dims = star.dimensions(candidates)
    tables = dims | {
        "candidates": candidates,
        "applications": rows.select(TABLES["applications"].names),
        "stage_events": stages.closed_stage_events(rows),
        "dim_time": star.dim_time(rows),
        "fact_application": star.fact_application(rows, dims),
    }
    return check(tables)


#: Three deliveries of the raw rows, each with a location of its own.
DELIVERIES = ["Urban", "Semiurban", "Rural"]


def _delivered(raw: DataFrame) -> list[DataFrame]:
    return [raw.where(F.col("location") == place) for place in DELIVERIES]


def _applications_flat_star_by_batches(raw: DataFrame) -> DataFrame:
    """The star after two batches, the first of them offered twice."""
    spark, folder = raw.sparkSession, shared_path(raw.sparkSession, "batches")
    first, *rest = _delivered(raw)
    for name, rows in [("first", first), ("first", first), ("rest", reduce(DataFrame.unionByName, rest))]:
        batches.append_tables(rows, folder, name)
    tables = warehouse.read_tables(spark, folder)
    return marts.applications_flat_star(tables["fact_application"], tables)


def _stage_events_closed_by_batches(raw: DataFrame) -> DataFrame:
    """Stored events after three batches by stage, so that later ones update exits of the ones before."""
    spark, folder = raw.sparkSession, shared_path(raw.sparkSession, "event-store")
    events = written(stages.stage_events(load.journeys(raw)), "events")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for some in (["Applied", "Hired"], ["Interviewed"], ["Screened", "Offered"]):
        event_store.merge_events(events.where(F.col("stage_name").isin(some)), folder, "-".join(some), buckets)
    return event_store.read_events(spark, folder)


def _of_buckets(build: Callable[[DataFrame, dict[str, DataFrame]], DataFrame]) -> Query:
    """Facts with their stages, from both facts stored in buckets of the application; and the dimensions."""

    def run(raw: DataFrame) -> DataFrame:
        spark = raw.sparkSession
        fact, dims = _fact(raw)
        events = star.fact_stage_event(stages.closed_stage_events(load.journeys(raw)))
        facts = {"fact_application": fact, "fact_stage_event": events}
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        stored = bucketed.write_bucketed(facts, shared_path(spark, "bucketed"), buckets)
        return build(marts.with_reached(stored["fact_application"], stored["fact_stage_event"]), dims)

    return _of_raw(run)


def _dim_by_batches(name: str) -> Query:
    """A dimension after three batches and one of them again: members keep the key they got first."""

    def run(raw: DataFrame) -> DataFrame:
        first, *rest = _delivered(raw)
        dim = star.attribute_dims(load.candidates(first), [name])[name]
        for rows in [*rest, first]:
            dim = dim.unionByName(star.new_members(load.candidates(rows), {name: dim})[name])
        return dim

    return _of_raw(run)


def _dim_time_by_batches(raw: DataFrame) -> DataFrame:
    """The calendar after three batches, the one in the middle of time first."""
    rows = load.applications(raw)
    middle = rows.where(F.col("application_id").between(10_000, 20_000))
    days = written(star.dim_time(middle), "days")
    for batch in (rows.where(F.col("application_id") > 20_000), rows.where(F.col("application_id") < 10_000)):
        days = days.unionByName(written(star.new_days(batch, days), "days"))
    return days


def _stored_ids(raw: DataFrame) -> DataFrame:
    """All raw rows as a batch, tested against the index of the first delivery."""
    first, *_ = _delivered(raw)
    index = written(key_index(raw, "serial_no"), "index")
    stored = written(key_index(first, "serial_no"), "index")
    bits = [F.col(b) for b in BITS]
    none = F.lit(0).cast("long")
    own = index.select(F.col("n").alias("rows"), count_bits(bits).cast("long").alias("ids"), none.alias("stored"))
    shared = batches.shared_keys(index, stored).select(none.alias("rows"), none.alias("ids"), F.col("n").alias("stored"))
    sums = [F.sum(c).alias(name) for c, name in (("rows", "batch_rows"), ("ids", "batch_ids"), ("stored", "stored_ids"))]
    return own.unionByName(shared).agg(*sums)


def _of_states(view: str) -> Query:
    """A view from the stored states of three batches."""

    def run(raw: DataFrame) -> DataFrame:
        kept = [written(states.load_states(load.journeys(rows)), "states") for rows in _delivered(raw)]
        dims = star.listed_dims(raw.sparkSession)
        return states.view_frames(reduce(DataFrame.unionByName, kept), dims)[view]

    return _of_raw(run)


def queries() -> dict[str, Query]:
    return {
        # load
        "raw_row_count": _of_raw(load.raw_row_count),
        "candidates": _of_raw(load.candidates),
        "applications": _of_raw(load.applications),
        "base_table_counts": _of_base(lambda apps, cands: load.base_table_counts(cands, apps)),
        # stages
        "stage_events": _of_journeys(stages.stage_events),
        "stage_events_from_tables": _of_raw(_stage_events_from_tables),
        "stage_events_closed": _of_journeys(stages.closed_stage_events),
        "stage_events_closed_from_events": _of_events(stages.stage_events_closed),
        "stage_counts_unfiltered": _of_events(marts.stage_counts_unfiltered),
        # star schema
        "dim_education": _of_raw(lambda raw: star.dim_education(load.candidates(raw))),
        "dim_location": _of_raw(lambda raw: star.dim_location(load.candidates(raw))),
        "dim_python": _used_members("dim_python"),
        "dim_internship": _used_members("dim_internship"),
        "dim_recruiter": _used_members("dim_recruiter"),
        "dim_source": _used_members("dim_source"),
        "dim_role": _used_members("dim_role"),
        "dim_time": _of_raw(lambda raw: star.dim_time(load.applications(raw))),
        "fact_application": _of_raw(lambda raw: _fact(raw)[0]),
        "fact_application_from_tables": _of_raw(_fact_application_from_tables),
        "fact_stage_event": _of_closed(star.fact_stage_event),
        # marts
        "funnel_counts": _of_journeys(marts.funnel_counts),
        "funnel_counts_from_events": _of_events(lambda ev: marts.funnel_counts(stages.reached_stages(ev))),
        "conversion_overall": _of_journeys(marts.conversion_overall),
        "conversion_overall_from_events": _of_events(lambda ev: marts.conversion_overall(stages.reached_stages(ev))),
        "stage_durations": _of_closed(marts.stage_durations),
        "stage_durations_star": _of_closed(lambda ev: marts.stage_durations(star.fact_stage_event(ev))),
        "conversion_by_education": _of_journeys(marts.conversion_by_education),
        "conversion_by_education_from_tables": _of_base(marts.conversion_by_education_from_tables),
        "conversion_by_location": _of_journeys(marts.conversion_by_location),
        "conversion_by_location_from_tables": _of_base(marts.conversion_by_location_from_tables),
        "applications_flat": _of_journeys(marts.applications_flat),
        "applications_flat_from_tables": _of_base(marts.applications_flat_from_tables),
        "applications_flat_star": _of_raw(lambda raw: marts.applications_flat_star(*_fact(raw))),
        "funnel_by_slice": _of_keyed(marts.funnel_by_slice),
        "funnel_by_slice_from_facts": _of_facts(
            lambda fact, events, dims: marts.funnel_by_slice(marts.with_reached(fact, events), dims)
        ),
        "cohort_conversion": _of_keyed(lambda rows, dims: marts.cohort_conversion(rows)),
        "cohort_conversion_from_facts": _of_facts(
            lambda fact, events, dims: marts.cohort_conversion(marts.with_reached(fact, events))
        ),
        "cohort_conversion_by_order_date": _of_raw(_cohort_by_order_date),
        "score_band": _of_journeys(marts.score_band),
        # batches
        "applications_flat_star_by_batches": _of_raw(_applications_flat_star_by_batches),
        "dim_location_by_batches": _dim_by_batches("dim_location"),
        "dim_education_by_batches": _dim_by_batches("dim_education"),
        "dim_time_by_batches": _of_raw(_dim_time_by_batches),
        "stored_ids": _of_raw(_stored_ids),
        "stage_events_closed_by_batches": _of_raw(_stage_events_closed_by_batches),
        "funnel_by_slice_from_buckets": _of_buckets(marts.funnel_by_slice),
        "cohort_conversion_from_buckets": _of_buckets(lambda reached, dims: marts.cohort_conversion(reached)),
        "funnel_by_slice_from_states": _of_states("v_funnel_by_slice"),
        "cohort_conversion_from_states": _of_states("v_cohort_conversion"),
        "stage_durations_from_states": _of_states("v_stage_durations"),
        "conversion_overall_from_states": _of_states("v_conversion_overall"),
        "conversion_by_education_from_states": _of_states("v_conversion_by_edu"),
        "score_band_from_states": _of_states("v_score_band"),
        # export and data quality
        "export_csv": _of_raw(_export_csv),
        "constraint_violations": _of_raw(_constraint_violations),
        "constraint_violations_by_bits": _of_raw(
            lambda raw: _constraint_violations(raw, key_checks.violations_by_bits)
        ),
    }
