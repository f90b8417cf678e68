"""Queries on random markup and random turns, against DuckDB."""

import random

import duckdb
import pytest

import __spark_entry__ as entry

# URLs have a blank in front: the SQL needs a character there to tell a URL
# from the end of another word, and RE2 cannot look behind.
TOKENS = (
    "word ", "Two words. ", "\n", "\n\n", "\n\n\n", " ", "\t", "\u00a0", "\u2003", "\x85", "\u2028", "\r\n", "é", "\U0001f600",
    "# h\n", "## h2 ", "### h3\n", "#### h4\n", "#x\n", "```\n", "x" * 130, "y" * 299, "z" * 300, "w" * 3000,
    "<figure>", "</figure>", "<img ", '<img src="', "data:image/png;base64,", "data:image/", "QUJD+/=", ">", "![", "a](", ")", "]",
    "{name}", "{a-b}", "{", "}", "{1}", "{ü_}", "{product-version}", "{name-a}", "{{", "kebab}",
    ":name: v\n", "\n:x:\n", "\n:x: {name}\n", "\n:na-me_1: a b \t\n", ":::\n", "\n:1a: no\n", "\n:!x: no\n",
    "\ninclude::a[]\n", "include::", "\nifdef::a[]\n", "\nendif::[]\n", "ifndef::", '\n[id="q"]\n', '\n[id="q"] z]  \n\n', '[id="',
    "\n= t\n", "\n====== t\n", "\n======= t\n", "\n* a\n", "\n*** a\n", "\n****** a\n", "\n. a\n", "\n.. a\n", "\n.T\n", "\n*b* c\n",
    "\n----\n", "\n------ \n", "\n[source,bash]\n----\n", "\n[source,c++,x]\n-----\n", "link:a[b]", "link:a[]", " https://x.y/z[t]", " http://q[]", "image:https://x[a]",
    "---", "- x\n", "* ", "= ",
    "\n....\n", "\n.....\n", "\n////\n", "\n|===\n", "\n|====\n", '\n[cols="2*"]\n|===\n', "|a |b\n", "|", "\\|", "\n-----\n",
    "\nimage::p[q, r]\n", "xref:a[b]", "xref:a.b#c[d]", "<<e>>", "<<f, g>>", "\n........ a\n",
)
NAMES = (
    "clean_technical", "clean_technical_strict", "split_sections", "chunk_documents", "chunk_documents_small",
    "merged_chunks", "dedup_chunks", "adoc_attributes", "adoc_attributes_across_lines", "adoc_clean", "adoc_to_markdown", "generate_qa",
)

TAGS = ("<think>", "</think>", "<reasoning>", "</reasoning>", "<reflection>", "</reflection>", "<Think>", "</", "<think/>")
QUOTES = ('"', '""', ",", "\\", '\\"', "'", "#", ";", "NA", "null", "\x08", "\x1f", "\x7f")
TURN_TOKENS = TAGS * 2 + QUOTES + TOKENS[:14]
TURN_NAMES = (
    "strip_traces", "valid_qa", "qa_counts", "chat_messages", "chat_messages_no_system", "jsonl_round_trip", "csv_round_trip",
)


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark, tmp_path_factory):
    rng = random.Random(request.param)
    texts = ["", " ", "\n\n", *("".join(rng.choices(TOKENS, k=rng.randrange(1, 60))) for _ in range(400))]
    # A third of all documents are copies of one.
    texts += [texts[50]] * 200
    rows = [(i, text, "en", f"src{i % 3}", len(text)) for i, text in enumerate(texts)]
    folder = tmp_path_factory.mktemp("fuzz")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    turns = [
        (i // 4, i % 4, ("user", "assistant")[i % 2], "".join(rng.choices(TURN_TOKENS, k=rng.randrange(12))))
        for i in range(1200)
    ]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(
        f"{folder}/conversations.parquet"
    )
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    return str(folder), connection


@pytest.mark.parametrize("name", NAMES + TURN_NAMES)
def test_random_markup(spark, data, name):
    folder, duck = data
    frame = entry.queries()[name](spark, folder)
    columns = sorted(frame.columns)
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    got = sorted((tuple(row) for row in frame.select(columns).collect()), key=repr)
    expected.sort(key=repr)
    different = [(g, e) for g, e in zip(got, expected, strict=False) if g != e]
    assert not different[:1]
    assert len(got) == len(expected)
