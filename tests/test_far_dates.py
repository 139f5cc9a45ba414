"""Every result with a date, past the year 9999, against its SQL: dates as numbers of days."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagelight import oracle, registry

KEYS = [*range(0, 200), *range(2_912_900, 2_913_100), *range(4_000_000, 4_000_100), *range(15_000_000, 15_000_100)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Orders with keys around 1, 2.9, 4 and 15 million."""
    place = str(tmp_path_factory.mktemp("far"))
    orders = [
        (k, k % 7, "FOP"[k % 3], 1000.0 + k % 900 * 400, dt.datetime(1995, 1 + k % 12, 3), f"{1 + k % 5}-URGENT"[:8])
        for k in KEYS
    ]
    schema = """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,
        o_orderpriority string"""
    customers = [(k, k % 5, 100.0 * k, ["AUTOMOBILE", "BUILDING"][k % 2]) for k in range(7)]
    spark.createDataFrame(orders, schema).write.parquet(f"{place}/orders.parquet")
    named = "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(customers, named).write.parquet(f"{place}/customer.parquet")
    return place


@pytest.fixture(scope="module")
def connection(folder):
    found = duckdb.connect()
    for name in ("orders", "customer"):
        found.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet/*.parquet')")
    return found


DATED = [
    "applications", "stage_events", "stage_events_from_tables", "stage_events_closed", "stage_events_closed_from_events",
    "fact_application", "fact_application_from_tables", "fact_stage_event", "stage_durations", "stage_durations_star",
    "applications_flat", "applications_flat_from_tables", "applications_flat_star", "cohort_conversion",
    "cohort_conversion_from_facts", "cohort_conversion_by_order_date", "funnel_by_slice_from_facts", "export_csv",
]


@pytest.mark.parametrize("name", DATED)
def test_as_the_oracle(spark, folder, connection, name):
    df = registry.queries()[name](spark, folder)
    dates = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
    shown = ", ".join(f"{c} - date '1970-01-01' as {c}" if c in dates else c for c in sorted(df.columns))
    expected = connection.execute(f"select {shown} from ({oracle.oracle_sql()[name]})").fetchall()
    found = df.select([F.unix_date(c).alias(c) if c in dates else F.col(c) for c in sorted(df.columns)]).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_the_calendar_is_whole(spark, folder, connection):
    """15 million days, compared by sums."""
    df = registry.queries()["dim_time"](spark, folder)
    sums = df.agg(F.count(F.lit(1)), F.sum(F.unix_date("date_key")), F.sum("year"), F.sum("quarter"), F.sum("month"), F.sum("week"))
    query = """select count(*), sum(date_key - date '1970-01-01'), sum(year), sum(quarter), sum(month), sum(week)"""
    expected = connection.execute(f"{query} from ({oracle.oracle_sql()['dim_time']})").fetchone()
    assert tuple(sums.first()) == expected and expected[0] == 15_000_100
