"""Every registered query against its SQL in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import TESTDATA
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES

SF_DIR = TESTDATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = contract.queries()[name](spark, str(SF_DIR))
    result = tables.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = sorted_rows(names, result.fetchall())
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == expected
    assert expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
