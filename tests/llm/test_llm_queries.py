"""The registered queries, where SQL can express them, against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "conversations", "embeddings")


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in found), key=repr)


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    result = connection.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for t in (*TABLES, "benchmark", "pages", "labels"):
        empty = spark.read.parquet(f"{SF_DIR}/{t}.parquet").limit(0)
        empty.write.parquet(str(tmp_path / f"{t}.parquet"))
    found = QUERIES[name](spark, str(tmp_path)).collect()
    assert len(found) == (1 if name == "op10_chat" else 0)  # the probe
