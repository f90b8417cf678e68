"""Every registered query against its SQL in DuckDB, and checks on plans."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR
from docloom.plans import oracle as _oracle
from docloom.plans import queries as _queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER"}
QUERIES = _queries.queries()
ORACLE = _oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    relation = duck.sql(ORACLE[name])
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert types == {column: SQL_TYPES[kind] for column, kind in frame.dtypes}
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    got = [tuple(row) for row in frame.select(columns).collect()]
    assert got
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"resumable_generation", "jsonl_round_trip", "csv_round_trip"}))
def test_plans(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas", plan)
    # No query reads a column it does not need.
    for columns in re.findall(r"FileScan parquet \[([^\]]*)\]", plan):
        assert "n_chars" not in columns


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "pos", "document", "document_outline", "domain"]
