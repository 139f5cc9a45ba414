"""Operators that SQL can express against it, on whole tables."""

import duckdb
import pytest

from stagelight.llm.oracle import oracle_sql
from stagelight.llm.queries import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_as_the_oracle(spark, name):
    connection = duckdb.connect()
    for view in ("documents", "conversations"):
        connection.execute(f"create view {view} as select * from '{SF_DIR}/{view}.parquet'")
    result = connection.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    expected = sorted(map(repr, result.fetchall()))
    assert sorted(map(repr, map(tuple, queries()[name](spark, SF_DIR).select(names).collect()))) == expected
