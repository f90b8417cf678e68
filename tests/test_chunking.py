import re
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import chunking as c
from docloom.operators.chunks import chunk_documents, chunks_per_document


def chunks_of(value, text, max_chars=2500):
    return value(lambda col: c.chunk_array(col, max_chars), text)


@pytest.mark.parametrize("text", ["", " \n\t", " \n\n "])
def test_blank_text_has_no_chunk(value, text):
    assert chunks_of(value, text) == []


def test_section_below_limit_is_one_chunk(value):
    text = "# h\n" + "x" * 2495
    assert len(text) == 2499
    assert chunks_of(value, text) == [text]


def test_section_at_limit_is_split_by_paragraphs(value):
    text = "# h\n\n" + "x" * 2490 + "\n\nyyy"
    assert len(text) == 2500
    # "# h" and the long paragraph fit; the last one does not (2495 + 3 + 2).
    assert chunks_of(value, text) == ["# h\n\n" + "x" * 2490, "yyy"]


@pytest.mark.parametrize("n", [2498, 2499])
def test_paragraph_just_below_limit(value, n):
    text = "a" * n + "\n\n" + "b" * 10
    assert chunks_of(value, text) == ["a" * n, "b" * 10]


def test_long_paragraph_is_sliced(value):
    assert [len(x) for x in chunks_of(value, "z" * 5001)] == [2500, 2500, 1]


def test_blank_slice_is_dropped(value):
    assert chunks_of(value, "z" * 2500 + " " * 2500) == ["z" * 2500]


def test_what_is_a_split_point(value):
    text = "intro\n#x no\n#### deep\n  # indented\n# one\ntext\n```\n# comment\n```\n### three\n"
    assert value(c.sections, text) == [
        "intro\n#x no\n#### deep\n  # indented\n",
        "# one\ntext\n```\n",
        "# comment\n```\n",
        "### three\n",
    ]


def test_leading_blank_section_is_dropped(value):
    assert value(c.sections, "\n\n# a\n") == ["# a\n"]


def test_greedy_packing_joins_with_nothing(value):
    text = "# a\n1\n# b\n2\n# c\n3\n"
    assert chunks_of(value, text, 13) == ["# a\n1\n# b\n2", "# c\n3"]
    # The limit is strict: twelve characters do not fit below twelve.
    assert chunks_of(value, text, 12) == ["# a\n1", "# b\n2", "# c\n3"]


def test_oversized_section_flushes_and_leaves_nothing_open(value):
    text = "# a\n1\n" + "# b\n\n" + "y" * 12 + "\n\ntail\n" + "# c\n3\n"
    # The tail of the oversized section is not packed with the next one.
    assert chunks_of(value, text, 16) == ["# a\n1", "# b", "y" * 12, "tail", "# c\n3"]


def test_paragraph_separator_is_kept_between_packed_paragraphs(value):
    assert chunks_of(value, "aa\n\n\n\nbb\n\n" + "c" * 9, 10) == ["aa\n\nbb", "c" * 9]


def test_code_points(value):
    text = "\U0001f600" * 7 + "é"
    assert chunks_of(value, text, 4) == ["\U0001f600" * 4, "\U0001f600" * 3 + "e", "́"]


def test_max_chars_must_be_positive():
    with pytest.raises(ValueError, match="max_chars"):
        c.chunk_array(F.lit("x"), 0)


PIECES = st.lists(
    st.sampled_from(["# a ", "## b\n", "#### c\n", "\n", "\n\n", "word ", "é\U0001f600", "x" * 17, " ", "\t", "```\n"]),
    max_size=40,
).map("".join)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(PIECES, min_size=1, max_size=20), limit=st.integers(3, 40))
def test_chunk_invariants(spark, texts, limit):
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, md string")
    rows = {r["id"]: r["chunks"] for r in frame.select("id", c.chunk_array(F.col("md"), limit).alias("chunks")).collect()}
    for i, text in enumerate(texts):
        chunks = rows[i]
        assert all(0 < len(chunk) <= limit for chunk in chunks)
        # Nothing but white space is lost, and order is kept.
        assert re.sub(r"\s", "", "".join(chunks)) == re.sub(r"\s", "", text)
        assert all(chunk == chunk.strip() for chunk in chunks)


def test_rows_and_counts_do_not_depend_on_partitioning(spark):
    docs = spark.range(60).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("# t\n"), F.repeat(F.lit("some words. "), F.col("id").cast("int") * 20)).alias("md"),
    )
    one = chunk_documents(docs.coalesce(1), max_chars=500).collect()
    many = chunk_documents(docs.repartition(7), max_chars=500).collect()
    assert sorted(one) == sorted(many)
    per_document = {r["doc_id"]: r["n_chunks"] for r in chunks_per_document(docs, max_chars=500).collect()}
    assert sum(per_document.values()) == len(one)
    for doc_id in (0, 30, 59):
        assert sorted(r["pos"] for r in one if r["doc_id"] == doc_id) == list(range(per_document[doc_id]))


def test_document_without_chunks_gives_no_row(spark):
    docs = spark.createDataFrame([(1, "{gone}"), (2, "kept")], "doc_id int, md string")
    assert [(r["doc_id"], r["pos"], r["chunk"]) for r in chunk_documents(docs).collect()] == [(2, 0, "kept")]


def test_long_document_with_many_chunks(spark):
    """Ten thousand chunks in one document must not cost much more than its
    length; a fold that copies all finished chunks at every step takes
    minutes here."""

    def repeated(text, times):
        # Depends on the row, so that it is not computed while planning.
        md = F.repeat(F.concat(F.lit(text), F.col("id").cast("string"), F.lit("\n")), times)
        return spark.range(1).select(F.col("id").alias("doc_id"), md.alias("md"))

    started = time.monotonic()
    assert chunk_documents(repeated("# h\n" + "w" * 60, 100_000), max_chars=700).count() == 10_000
    assert chunk_documents(repeated("abcdefgh", 1_000_000), max_chars=2500).count() == 4_000
    assert time.monotonic() - started < 60
