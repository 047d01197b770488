"""Queries of the subpackage against their DuckDB SQL."""

import pytest

from hirelake.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == expected
    assert expected
