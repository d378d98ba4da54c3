"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

from compare import duckdb_connection, rows_of
from study_queries import oracles, registry

FOLDER = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def context(spark):
    return registry.Context(spark, FOLDER)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(FOLDER)


def test_every_check_has_a_query():
    assert set(oracles.CHECKS) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(name, context, con):
    df = registry.QUERIES[name](context)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles.CHECKS:
        assert got
        return
    result = con.execute(oracles.check_sql(name))
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, result.fetchall())
