from pathlib import Path

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from docloom.operators import generators as g
from docloom.streaming import generation as s

SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("chunk_id", "question", "response")]
)
WITH_ERROR = T.StructType([*SCHEMA.fields, T.StructField("error", T.StringType())])


def inputs(spark, ids):
    rows = [(f"c{i:03d}", i, 0, f"text {i}. More of {i}", "", "Net") for i in ids]
    return spark.createDataFrame(
        rows, "chunk_id string, doc_id long, pos int, document string, document_outline string, domain string"
    )


def maker(log, fail_on=""):
    """Two rows per chunk, none for every tenth; writes down its calls.  The
    file whose name is ``fail_on`` makes it fail as long as it exists."""

    def make(batch, timeout):
        import os
        import uuid

        if fail_on and os.path.exists(fail_on) and (batch["document"] == "text 30. More of 30").any():
            raise RuntimeError("endpoint gone")
        with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(batch["chunk_id"]))
        wanted = batch[~batch["chunk_id"].str.endswith("0")]
        rows = [
            (row.chunk_id, f"q{k} {row.domain} {timeout}", f"<think>t</think>a{k} {row.document}")
            for row in wanted.itertuples() for k in range(2)
        ]
        return pd.DataFrame(rows, columns=["chunk_id", "question", "response"])

    return make


def calls(log):
    return sorted(line for f in log.iterdir() for line in f.read_text().splitlines())


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    return folder


@pytest.fixture
def registered(monkeypatch):
    monkeypatch.setattr(g, "_REGISTRY", dict(g._REGISTRY))
    return g.register_generator


def test_unknown_generator_names_the_known_ones():
    with pytest.raises(ValueError, match=r"'nope' not found.*sentences"):
        g.get_generator("nope")


def test_sentence_generator(spark):
    rows = g.generate_qa(inputs(spark, [7])).orderBy("fact_no", "qa_no").collect()
    assert [r["response"] for r in rows] == ["text 7", "2", "More of 7", "3"]
    assert rows[0]["question"] == "What does the Net documentation say about: text 7?"


def test_pandas_generator(spark, log, registered):
    registered("maker", g.PandasGenerator(maker(str(log)), SCHEMA))
    made = g.generate_qa(inputs(spark, range(20)), "maker", concurrency=3, timeout=9)
    assert made.rdd.getNumPartitions() == 3
    rows = made.collect()
    assert len(rows) == 36
    assert rows[0]["question"].endswith("Net 9")


def test_wrong_columns_are_refused(spark, registered):
    registered("wrong", g.PandasGenerator(lambda b, t: b[["chunk_id"]], SCHEMA))
    with pytest.raises(Exception, match="generator returned columns"):
        g.generate_qa(inputs(spark, [1]), "wrong").collect()


def test_errors_in_a_column(spark, registered):
    def picky(batch, timeout):
        if (batch["chunk_id"] == "c003").any():
            raise KeyError("bad chunk")
        return batch[["chunk_id"]].assign(question="q", response="r")

    registered("picky", g.PandasGenerator(picky, WITH_ERROR, on_error="column"))
    rows = {r["chunk_id"]: r for r in g.generate_qa(inputs(spark, range(6)), "picky", concurrency=1).collect()}
    assert len(rows) == 6
    assert rows["c003"]["error"].startswith("KeyError") and rows["c003"]["question"] is None
    assert rows["c002"]["question"] == "q" and rows["c002"]["error"] is None
    with pytest.raises(ValueError, match="on_error"):
        g.PandasGenerator(picky, WITH_ERROR, on_error="ignore")
    with pytest.raises(ValueError, match="chunk_id and error"):
        g.PandasGenerator(picky, SCHEMA, on_error="column")


def test_pending_and_plan(spark):
    chunks = inputs(spark, range(60))
    done = chunks.where("doc_id < 50").select("chunk_id")
    assert sorted(r["doc_id"] for r in s.pending_chunks(chunks, done).collect()) == list(range(50, 60))
    plan = s.batch_plan(chunks.repartition(5)).orderBy("batch_no").collect()
    assert [(r["first_chunk"], r["last_chunk"], r["n_chunks"]) for r in plan] == [(1, 25, 25), (26, 50, 25), (51, 60, 10)]


def test_chunk_files_hold_one_batch_each(spark, tmp_path):
    run = s.open_run(spark, str(tmp_path))
    s.stage_chunks(run, inputs(spark, range(60)).coalesce(1))
    sizes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "run=00001" / "staged").glob("part-*")]
    assert sorted(sizes) == [10, 25, 25]


def finished(run, spark, name):
    return sorted(tuple(r) for r in s.read_generated(run, spark, name).collect())


def test_failed_run_resumes_to_the_same_result(spark, tmp_path, log, registered):
    switch = tmp_path / "broken"
    switch.touch()
    registered("shaky", g.PandasGenerator(maker(str(log), str(switch)), SCHEMA))
    chunks = inputs(spark, range(60)).coalesce(1)
    base = str(tmp_path / "gen")
    run = s.open_run(spark, base)
    s.stage_chunks(run, chunks)
    with pytest.raises(Exception, match="endpoint gone"):
        s.process_staged(run, spark, "shaky", concurrency=2)
    before = s.run_progress(run, spark).first()
    assert before["chunks_done"] < before["chunks_total"] == 60
    assert before["chunks_done"] % 5 == 0

    switch.unlink()
    resumed = s.open_run(spark, base, resume=True)
    assert resumed == run
    done_before = {r["chunk_id"] for r in s.read_ledger(run, spark).collect()}
    log_before = calls(log)
    s.stage_chunks(resumed, chunks)
    assert s.process_staged(resumed, spark, "shaky", concurrency=2) == 2
    assert s.process_staged(resumed, spark, "shaky", concurrency=2) is None
    # Finished chunks are not sent again; every chunk is in the ledger once.
    new_calls = list(calls(log))
    for call in log_before:
        new_calls.remove(call)
    assert not done_before & set(new_calls)
    assert sorted(r["chunk_id"] for r in s.read_ledger(run, spark).collect()) == [f"c{i:03d}" for i in range(60)]
    after = s.run_progress(run, spark).first()
    assert tuple(after) == (3, 2, 60, 60)

    registered("steady", g.PandasGenerator(maker(str(log)), SCHEMA))
    straight = s.resumable_generation(chunks, str(tmp_path / "other"), "steady", concurrency=2)
    assert finished(run, spark, "shaky") == sorted(tuple(r) for r in straight.collect())
    assert len(straight.collect()) == 108
    assert all("<think>" not in r["response"] for r in straight.collect())


def test_nothing_left_and_new_input(spark, tmp_path, log, registered):
    registered("maker", g.PandasGenerator(maker(str(log)), SCHEMA))
    base = str(tmp_path / "gen")
    first = s.resumable_generation(inputs(spark, range(30)), base, "maker", concurrency=2)
    assert first.count() == 54
    assert len(calls(log)) == 30
    again = s.resumable_generation(inputs(spark, range(30)), base, "maker", resume=True, concurrency=2)
    assert again.count() == 54
    assert len(calls(log)) == 30
    more = s.resumable_generation(inputs(spark, range(40)), base, "maker", resume=True, concurrency=2)
    assert more.count() == 72
    assert calls(log) == [f"c{i:03d}" for i in range(40)]


def test_replayed_batch_overwrites_itself(spark, tmp_path, log, registered):
    """A crash after the rows were written and before the batch was
    committed: the commit mark is taken away and the run started again."""
    registered("maker", g.PandasGenerator(maker(str(log)), SCHEMA))
    run = s.open_run(spark, str(tmp_path))
    s.stage_chunks(run, inputs(spark, range(50)).coalesce(1))
    s.process_staged(run, spark, "maker", concurrency=2)
    expected = finished(run, spark, "maker")
    commits = tmp_path / "run=00001" / "checkpoint" / "commits"
    for mark in (commits / "1", commits / ".1.crc"):
        if mark.exists():
            mark.unlink()
    s.process_staged(run, spark, "maker", concurrency=2)
    assert finished(run, spark, "maker") == expected
    assert len(calls(log)) == 75
    assert s.read_ledger(run, spark).count() == 50


def test_fresh_run_keeps_the_old_one(spark, tmp_path):
    chunks = inputs(spark, range(5))
    s.resumable_generation(chunks, str(tmp_path))
    s.resumable_generation(chunks, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["run=00001", "run=00002"]
    assert s.open_run(spark, str(tmp_path), resume=True).root.endswith("run=00002")


def test_input_without_chunks(spark, tmp_path):
    made = s.resumable_generation(inputs(spark, [0]).limit(0), str(tmp_path))
    assert made.count() == 0
    assert made.columns == g.SentenceGenerator.schema.names
    run = s.open_run(spark, str(tmp_path), resume=True)
    assert tuple(s.run_progress(run, spark).first()) == (0, None, 0, 0)


def test_tables_of_a_run_are_packed_tightly(spark, tmp_path):
    """Rows repeat their facts; the run writes them with a codec that finds that."""
    chunks = [(f"c{i}", f"One fact of {i}. Another fact of {i}.", "", "General") for i in range(20)]
    frame = spark.createDataFrame(chunks, "chunk_id string, document string, document_outline string, domain string")
    run = s.open_run(spark, str(tmp_path))
    s.stage_chunks(run, frame)
    s.process_staged(run, spark, files_per_batch=8)
    for folder in (run.staged, run.qa):
        files = [path for path in Path(folder).rglob("*.parquet") if pq.read_metadata(path).num_row_groups]
        assert files
        assert {pq.read_metadata(path).row_group(0).column(0).compression for path in files} == {"ZSTD"}
    assert s.read_generated(run, spark).count() == 80
