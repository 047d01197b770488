"""Every registered query of the library itself against its DuckDB SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from harness.plan_queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == expected
    assert expected


def test_entry(spark):
    assert entry.entry(spark).columns == ["skill", "job_count"]
