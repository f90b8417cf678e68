"""Registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest
from conftest import SF_DIR
from odd_tables import no_docs, odd_docs  # noqa: F401

import __spark_entry__ as entry
import corpus_pipeline
from docloom.llm import queries as llm

TABLES = "documents embeddings pages benchmark labels conversations"


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES.split():
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    frame = llm.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({llm.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, frame.select(columns).collect()), key=repr) == sorted(expected, key=repr)


def test_registered():
    names = set(entry.queries())
    assert set(llm.queries()) < names and "pipeline" in names
    assert {name.split("_")[0] for name in llm.queries()} == {f"op{n}" for n in range(1, 14)}


def test_pipeline_stages(spark):
    """Every stage takes away or changes what its operator finds, no more."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(corpus_pipeline.saved(stage(spark, tables[-1], SF_DIR), "test"))
    raw, good, single, clean, masked, mix = ({r["doc_id"]: r["text"] for r in t.collect()} for t in tables)
    assert all(t.columns == docs.columns for t in tables[:-1])
    gone = set(raw) - set(good)
    assert gone and not any(labels.get(i) == 1 for i in gone)
    groups = corpus_pipeline.ngram_jaccard_groups(tables[1]).collect()
    assert set(single) == {r["component_id"] for r in groups}
    leaks = {r["doc_id"] for r in corpus_pipeline.drop_contaminated(tables[2], spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).collect()}
    assert set(clean) == leaks
    assert set(masked) == set(clean) and any("[EMAIL]" in t for t in masked.values())
    assert set(mix) <= set(masked) and all(masked[i] == t for i, t in mix.items())


def test_pipeline_odd_rows(spark, odd_docs):
    tables = [odd_docs]
    for _, stage in corpus_pipeline.STAGES[1:]:
        tables.append(corpus_pipeline.saved(stage(spark, tables[-1], SF_DIR), "test"))
        assert tables[-1].columns[: len(odd_docs.columns)] == odd_docs.columns
    ids = sorted(r["doc_id"] or 0 for r in tables[1].collect())
    assert ids == [0, 0, 1, 2, 3, 4, 5, 7, 8, 9]
