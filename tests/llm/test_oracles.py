import os

import duckdb
import pytest

from claimloom.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.sql(f"create view {file[:-8]} as select * from '{FOLDER}/{file}'")
    expected = connection.sql(queries.ORACLE_SQL[name])
    got = queries.queries()[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(expected.columns)
    assert sorted(map(tuple, got.select(expected.columns).collect())) == sorted(expected.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
