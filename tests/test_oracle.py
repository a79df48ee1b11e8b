"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import season_oracle as oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
}
SQL = oracle.statements()
# The operators for training data, if present, have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name in SQL}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as from '{FOLDER}/{table}.parquet'")
    return connection


def _sorted(found):
    return sorted(found, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert entry.oracle_sql().items() >= SQL.items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = _sorted(tuple(r) for r in df.select(*columns).collect())
    cursor = duck.execute(f"select {', '.join(columns)} from ({SQL[name]})")
    expected_types = {c[0]: str(c[1]) for c in cursor.description}
    assert {c: TYPES[t.replace("_ntz", "")] for c, t in df.dtypes} == expected_types
    assert found == _sorted(cursor.fetchall())
    assert found


def test_sql_and_query_have_the_same_columns(spark, duck):
    for name in ("stg_players", "dim_roster", "saved_pitcher_cost_efficiency"):
        cursor = duck.execute(SQL[name])
        assert {c[0] for c in cursor.description} == set(QUERIES[name](spark, FOLDER).columns)


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "player_salary__position", "player_salary__season_date__year", "total_salary_millions",
        "average_salary_millions", "contract_count",
    ]
