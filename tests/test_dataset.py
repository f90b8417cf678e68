import random

import pytest
from pyspark.sql import functions as F

from docloom.operators import chunks as ck
from docloom.operators import corpus
from docloom.operators.ordering import dense_index


@pytest.fixture
def chunks(spark):
    rows = [(2, 0, "a"), (1, 1, "a"), (1, 0, "b"), (3, 0, "c"), (3, 1, "c"), (3, 2, "b")]
    return spark.createDataFrame(rows, "doc_id long, pos int, chunk string")


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_first_copy_is_kept(chunks):
    assert as_set(ck.dedup_chunks(chunks), "doc_id", "pos", "chunk") == {(1, 1, "a"), (1, 0, "b"), (3, 0, "c")}


def test_dedup_is_idempotent_and_independent_of_partitioning(chunks):
    once = ck.dedup_chunks(chunks)
    assert as_set(ck.dedup_chunks(once), "*") == as_set(once, "*")
    assert as_set(ck.dedup_chunks(chunks.repartition(5)), "*") == as_set(once, "*")


def test_chunk_counts(chunks, spark):
    assert tuple(ck.chunk_counts(chunks).first()) == (6, 3, 3)
    assert tuple(ck.chunk_counts(chunks.limit(0)).first()) == (0, 0, 0)


def test_hot_chunk_against_brute_force(spark):
    """A third of all rows are copies of one chunk."""
    rng = random.Random(7)
    rows = [(i // 4, i % 4, "hot" if rng.random() < 0.34 else f"c{rng.randrange(400)}") for i in range(4000)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, pos int, chunk string").repartition(8)
    first = {}
    for doc_id, pos, chunk in sorted(rows):
        first.setdefault(chunk, (doc_id, pos, chunk))
    assert as_set(ck.dedup_chunks(frame), "doc_id", "pos", "chunk") == set(first.values())
    assert ck.chunk_counts(frame).first()["n_distinct"] == len(first)


def test_dedup_limits_before_the_shuffle(chunks):
    plan = ck.dedup_chunks(chunks)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > exchange


def test_generator_input(chunks):
    named = ck.generator_input(ck.dedup_chunks(chunks), "outline", "dom", 100, "g")
    row = named.where("document = 'a'").first()
    assert (row["document_outline"], row["domain"], row["doc_id"]) == ("outline", "dom", 1)
    assert len(row["chunk_id"]) == 64
    ids = as_set(named, "chunk_id")
    assert len(ids) == 3
    for other in (
        ck.generator_input(chunks, "other", "dom", 100, "g"),
        ck.generator_input(chunks, "outline", "dom", 101, "g"),
        ck.generator_input(chunks, "outline", "dom", 100, "h"),
        ck.generator_input(chunks, "outline", "d", 100, "g"),
    ):
        assert not ids & as_set(other, "chunk_id")


def test_source_metadata_has_defaults(spark):
    chunks = spark.createDataFrame([("s1", "x"), ("s2", "y"), (None, "z")], "source string, chunk string")
    metadata = spark.createDataFrame([("s1", "about", "Net")], "source string, document_outline string, domain string")
    got = as_set(ck.with_source_metadata(chunks, metadata), "chunk", "document_outline", "domain")
    assert got == {("x", "about", "Net"), ("y", "", "General"), ("z", "", "General")}


def test_dense_index(spark):
    rng = random.Random(3)
    keys = [(k, p) for k in rng.sample(range(500), 120) + [-3, -9, 10_000] for p in range(rng.randrange(1, 4))]
    frame = spark.createDataFrame(keys, "doc_id long, pos int").repartition(6)
    got = {(r["doc_id"], r["pos"]): r["idx"] for r in dense_index(frame, ("doc_id", "pos")).collect()}
    assert got == {key: i for i, key in enumerate(sorted(keys))}


def test_fingerprints(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    one = corpus.corpus_fingerprint(docs).first()
    assert (one["n_docs"], len(one["fingerprint"])) == (3, 12)
    assert corpus.corpus_fingerprint(docs.orderBy(F.desc("doc_id")).repartition(3)).first() == one
    assert corpus.corpus_fingerprint(docs.where("doc_id < 3")).first()["fingerprint"] != one["fingerprint"]
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 3, "b").otherwise(F.col("text")))
    assert corpus.corpus_fingerprint(changed).first()["fingerprint"] != one["fingerprint"]
    per_document = as_set(corpus.document_fingerprints(docs), "doc_id", "fingerprint")
    assert (1, "ca978112ca1b") in per_document


def test_merge_in_parts_is_the_whole_corpus(spark):
    docs = spark.range(50).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "big").otherwise("small").alias("source"),
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("md"),
    ).repartition(5)
    parts = corpus.merge_documents(docs, "source", "doc_id", docs_per_part=8).collect()
    assert max(r["n_docs"] for r in parts) <= 8
    for source, keep in (("big", lambda i: i % 3 == 0), ("small", lambda i: i % 3)):
        ordered = sorted((r for r in parts if r["source"] == source), key=lambda r: r["part"])
        assert "\n\n---\n\n".join(r["md"] for r in ordered) == "\n\n---\n\n".join(f"d{i}" for i in range(50) if keep(i))


def test_latest_by_base_name(spark):
    rows = [("a/x.adoc", "1"), ("b/x.pdf", "2"), ("b/y.v1.adoc", "3"), ("c/.hidden", "4"), ("noext", "5"), ("d/a..b", "6")]
    docs = spark.createDataFrame(rows, "path string, md string")
    got = as_set(corpus.latest_by_base_name(docs), "base_name", "md")
    assert got == {("x", "2"), ("y.v1", "3"), (".hidden", "4"), ("noext", "5"), ("a.", "6")}
