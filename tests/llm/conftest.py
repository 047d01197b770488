import os

import duckdb
import pytest


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


@pytest.fixture(scope="session")
def make(spark):
    """Documents with a clashing extra column."""

    def of(rows, schema="doc_id long, text string, fp long, keep_id string"):
        return spark.createDataFrame([(*r, 7, "x") if len(r) == 2 else r for r in rows], schema)

    return of
