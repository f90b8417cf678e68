import json

import pytest
from pyspark.sql import functions as F

from docloom.functions.messages import base_model
from docloom.operators import qa
from docloom.sources import sinks, tables

QA = "qa_id long, question string, response string"


@pytest.fixture
def raw(spark):
    rows = [
        (1, "q1", "<think>t</think> a1"),
        (2, "q2", "<think>only a trace</think>"),
        (3, None, "a3"),
        (4, "", "a4"),
        (5, "q5", None),
        (6, "qué \"x\"\n😀", "a6\\n"),
        (7, "q7", "NA"),
        (8, "q8", "null"),
    ]
    return spark.createDataFrame(rows, QA)


def ids(df):
    return {r["qa_id"] for r in df.collect()}


def test_strip_traces_on_string_columns_only(spark):
    frame = spark.sql(
        "SELECT 1 AS n, ' <think>x</think>a ' AS s, array('<think>x</think>b') AS l,"
        " named_struct('t', '<think>x</think>c', 'k', 2) AS st, CAST(NULL AS STRUCT<t: STRING>) AS none"
    )
    flat = qa.strip_traces(frame).first()
    assert (flat["n"], flat["s"], flat["l"][0]) == (1, "a", "<think>x</think>b")
    deep = qa.strip_traces(frame, nested=True).first()
    assert (deep["l"], deep["st"]["t"], deep["st"]["k"], deep["none"]) == (["b"], "c", 2, None)
    assert qa.strip_traces(frame, keep_cot=True).first()["s"] == " <think>x</think>a "


def test_strip_traces_is_idempotent(raw):
    once = qa.strip_traces(raw)
    assert sorted(qa.strip_traces(once).collect(), key=str) == sorted(once.collect(), key=str)


def test_valid_rows(raw):
    stripped = qa.strip_traces(raw)
    assert ids(qa.valid_qa(stripped)) == {1, 6, 7, 8}
    assert ids(qa.valid_qa(stripped, null_words=("NA", "null"))) == {1, 6}
    assert tuple(qa.qa_counts(stripped).first()) == (8, 4)


def test_missing_columns_are_named(spark):
    frame = spark.createDataFrame([("x", 1)], "question string, other int")
    with pytest.raises(ValueError, match=r"\['response'\].*question.*other"):
        qa.valid_qa(frame)


@pytest.mark.parametrize("prompt", [None, "", "You help."])
def test_chat_rows(spark, prompt):
    frame = spark.createDataFrame([("q", 12)], "question string, response int")
    messages = [tuple(m) for m in qa.chat_rows(frame, prompt).first()["messages"]]
    expected = [("user", "q"), ("assistant", "12")]
    assert messages == ([("system", prompt)] if prompt else []) + expected


def test_system_prompt_per_row(spark):
    frame = spark.createDataFrame([("q", "a", "p"), ("q", "a", ""), ("q", "a", None)], "question string, response string, p string")
    roles = [[m["role"] for m in r["messages"]] for r in qa.chat_rows(frame, F.col("p")).collect()]
    assert roles == [["system", "user", "assistant"], ["user", "assistant"], ["user", "assistant"]]


def test_prompt_rows(spark):
    frame = spark.createDataFrame([("q",)], "question string")
    assert [m["role"] for m in qa.prompt_rows(frame, "s").first()["messages"]] == ["system", "user"]


def test_jsonl(spark, raw, tmp_path):
    path = str(tmp_path / "train")
    assert sinks.write_chat_jsonl(qa.strip_traces(raw), path, "sys") == 4
    lines = [line for f in (tmp_path / "train").glob("part-*") for line in f.read_text(encoding="utf-8").splitlines()]
    assert len(lines) == 4
    assert any("qué" in line and "😀" in line for line in lines)
    parsed = [json.loads(line)["messages"] for line in lines]
    assert {m[1]["content"] for m in parsed} == {"q1", 'qué "x"\n😀', "q7", "q8"}
    back = tables.read_chat_jsonl(spark, path).collect()
    assert sorted([[m.asDict() for m in r["messages"]] for r in back], key=str) == sorted(parsed, key=str)


def test_jsonl_without_examples_fails(spark, tmp_path):
    empty = spark.createDataFrame([(1, "q", None)], QA)
    with pytest.raises(ValueError, match="no valid training examples"):
        sinks.write_chat_jsonl(empty, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="no valid training examples"):
        sinks.write_chat_jsonl(empty.limit(0), str(tmp_path / "none2"))


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'a "quoted", b\nline', " spaced "), (2, "", None), (3, "NA", "é"), (4, "#x", "back\\slash\\")]
    path = str(tmp_path / "csv")
    assert sinks.write_csv(spark.createDataFrame(rows, QA), path) == 4
    back = {r["qa_id"]: (r["question"], r["response"]) for r in tables.read_qa_csv(spark, path, QA).collect()}
    assert back == {1: ('a "quoted", b\nline', " spaced "), 2: (None, None), 3: ("NA", "é"), 4: ("#x", "back\\slash\\")}
    untyped = tables.read_qa_csv(spark, path, null_words=("NA",))
    assert untyped.columns == ["qa_id", "question", "response"]
    assert untyped.where("qa_id = '3'").first()["question"] is None


def test_csv_columns_in_other_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("question,response\nQ,R\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("response,question\nR,Q\n", encoding="utf-8")
    a, b = str(tmp_path / "a.csv"), str(tmp_path / "b.csv")
    assert tables.read_qa_csv(spark, b, "response string, question string").first()["question"] == "Q"
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_qa_csv(spark, b, "question string, response string").collect()
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_qa_csv(spark, [a, b]).collect()


def test_csv_written_by_others(spark, tmp_path):
    file = tmp_path / "qa.csv"
    file.write_text('question,response\n"a ""b""","two\nlines"\nplain,\n', encoding="utf-8")
    assert [tuple(r) for r in tables.read_qa_csv(spark, str(file)).collect()] == [('a "b"', "two\nlines"), ("plain", None)]


def test_dataset_write_counts_rows(spark, raw, tmp_path):
    assert sinks.write_dataset(raw, str(tmp_path / "d")) == 8
    assert spark.read.parquet(str(tmp_path / "d")).where("qa_id = 1").first()["response"] == "a1"


def test_base_model_configs(spark, tmp_path):
    for name, text in (("one", '{\n "base_model_name_or_path": "org/m",\n "r": 16}'), ("two", '{"r": 8}')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "adapter_config.json").write_text(text, encoding="utf-8")
    one = tables.resolve_base_models(spark, [str(tmp_path / "one")]).first()
    assert (one["base_model"], one["adapter_base_model"]) == ("org/m", "org/m")
    own = tables.resolve_base_models(spark, [str(tmp_path / "one")], "me/m").first()
    assert (own["base_model"], own["adapter_base_model"]) == ("me/m", "org/m")
    with pytest.raises(Exception, match="no base_model_name_or_path"):
        tables.resolve_base_models(spark, [str(tmp_path / "two")]).collect()


def test_base_model_expression(value):
    config = '{"base_model_name_or_path": "org/m"}'
    assert value(base_model, config, "") == "org/m"
    assert value(base_model, config, None) == "org/m"
    assert value(base_model, config, "me/m") == "me/m"
