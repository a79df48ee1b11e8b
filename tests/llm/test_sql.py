"""Queries that SQL can express, against DuckDB on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from seasonmart.llm import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "embeddings", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def test_registered():
    names = {f"op{n}" for n in range(1, 14)}
    assert {q.split("_")[0] for q in queries.QUERIES} == names
    assert entry.queries().keys() >= {*queries.QUERIES, "pipeline"}
    assert entry.oracle_sql().keys() >= queries.SQL.keys()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "bpe"]


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query(name, spark):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as from '{FOLDER}/{table}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = ordered(tuple(r) for r in df.select(*columns).collect())
    assert found
    assert found == ordered(duck.execute(f"select {', '.join(columns)} from ({queries.SQL[name]})").fetchall())
