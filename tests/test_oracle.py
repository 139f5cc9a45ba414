"""Every registered query against its SQL in DuckDB, on whole tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from stagelight import oracle, registry

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date"}


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else (round(v, 6) if isinstance(v, float) else v)

    return Counter(tuple((type(row[i]).__name__, plain(row[i])) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_matches_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF_DIR)
    result = duck.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in result.description]
    types = {d[0]: SPARK_TYPES[str(d[1])] for d in result.description}
    expected = rows_by_name(names, result.fetchall())
    assert dict(df.dtypes) == types
    actual = rows_by_name(df.columns, df.collect())
    assert actual.total() > 0
    assert actual == expected


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
