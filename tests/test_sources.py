import pytest

from docloom.operators import convert
from docloom.operators.corpus import merge_documents
from docloom.sources import documents as d
from docloom.sources import sinks


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "docs"
    (root / "deep" / "er").mkdir(parents=True)
    (root / "a.adoc").write_bytes(b":v: 4\r\n= A {v}\r\n")
    (root / "deep" / "b.pdf").write_bytes(b"%PDF\xff")
    (root / "deep" / "er" / "c.adoc").write_text("* é\n", encoding="utf-8")
    (root / "deep" / "bad.adoc").write_bytes(b"x\xff")
    (root / "UP.ADOC").write_text("upper", encoding="utf-8")
    (root / "note.txt").write_text("no", encoding="utf-8")
    (root / ".hidden.adoc").write_text("no", encoding="utf-8")
    return root


def names(df):
    return sorted(r["path"].rsplit("/", 1)[1] for r in df.select("path").collect())


def test_folders_are_scanned_recursively(spark, tree):
    assert names(d.read_documents(spark, [str(tree)])) == ["a.adoc", "b.pdf", "bad.adoc", "c.adoc"]
    assert names(d.read_documents(spark, [str(tree)], ignore_case=True)) == ["UP.ADOC", "a.adoc", "b.pdf", "bad.adoc", "c.adoc"]


def test_named_files_are_compared_without_case(spark, tree):
    found = d.read_documents(spark, [str(tree / "UP.ADOC"), str(tree / "note.txt"), str(tree / "deep")])
    assert names(found) == ["UP.ADOC", "b.pdf", "bad.adoc", "c.adoc"]


def test_overlapping_inputs_are_read_once(spark, tree):
    inputs = [str(tree), str(tree / "deep"), str(tree / "a.adoc"), str(tree)]
    assert names(d.read_documents(spark, inputs)) == ["a.adoc", "b.pdf", "bad.adoc", "c.adoc"]


def test_named_files_are_kept(spark, tree):
    """Beside their folder, in upper case, and with names that Spark hides."""
    (tree / "_part.adoc").write_text("under", encoding="utf-8")
    inputs = [str(tree), str(tree / "UP.ADOC"), str(tree / "_part.adoc"), str(tree / ".hidden.adoc"), str(tree / "a.adoc")]
    found = d.read_documents(spark, inputs)
    assert names(found) == [".hidden.adoc", "UP.ADOC", "_part.adoc", "a.adoc", "b.pdf", "bad.adoc", "c.adoc"]
    texts = {r["path"].rsplit("/", 1)[1]: r["text"] for r in d.read_texts(spark, inputs).collect()}
    assert texts["_part.adoc"] == "under" and texts["UP.ADOC"] == "upper"
    rows = {r["path"].rsplit("/", 1)[1]: r for r in found.collect()}
    assert rows["_part.adoc"]["length"] == 5 and rows["_part.adoc"]["modificationTime"] is not None
    got = {r["path"].rsplit("/", 1)[1]: r["status"] for r in d.discovery_report(spark, inputs).collect()}
    assert got["_part.adoc"] == got["UP.ADOC"] == got[".hidden.adoc"] == "supported"
    assert got["note.txt"] == "unsupported" and len(got) == 8


def test_every_file_of_a_tree_is_told(spark, tmp_path):
    """Names Spark passes over, names that are no URI, links and loops."""
    for folder in ("_under", ".git", "plain", "a b#c%20"):
        (tmp_path / folder / "in").mkdir(parents=True)
        for name in ("x.adoc", "_x.adoc", ".x.adoc", "x=y.adoc", "n.txt", "x.Adoc"):
            (tmp_path / folder / "in" / name).write_text(f"{folder}/{name}", encoding="utf-8")
    (tmp_path / "plain" / "up").symlink_to(tmp_path / "plain")
    (tmp_path / "plain" / "side").symlink_to(tmp_path / "_under" / "in")
    (tmp_path / "plain" / "gone.adoc").symlink_to(tmp_path / "nowhere")
    rows = d.discover_documents(spark, [str(tmp_path)]).collect()
    assert len({r["path"] for r in rows}) == len(rows)
    got = {r["path"].split(tmp_path.name + "/", 1)[1]: r["status"] for r in rows}
    folders = ["_under/in", "plain/in", "plain/side", "a b#c%20/in"]
    expected = {f".git/in/{n}": "hidden" for n in ("x.adoc", "_x.adoc", ".x.adoc", "x=y.adoc", "n.txt", "x.Adoc")}
    for folder in folders:
        expected |= {f"{folder}/{n}": "supported" for n in ("x.adoc", "_x.adoc", "x=y.adoc")}
        expected |= {f"{folder}/.x.adoc": "hidden", f"{folder}/n.txt": "unsupported", f"{folder}/x.Adoc": "unsupported"}
    assert got == expected
    texts = {r["path"].split(tmp_path.name + "/", 1)[1]: r["text"] for r in d.read_texts(spark, [str(tmp_path)]).collect()}
    assert set(texts) == {path for path, status in expected.items() if status == "supported"}
    assert texts["a b#c%20/in/_x.adoc"] == "a b#c%20/_x.adoc" and texts["plain/side/x.adoc"] == "_under/x.adoc"


def test_read_and_listed_files_are_the_same(spark, tree):
    listed = d.list_files(spark, [str(tree)]).collect()
    read = {r["path"]: r for r in d.read_documents(spark, [str(tree)]).collect()}
    assert {r["path"] for r in listed} == set(read)
    for row in listed:
        assert (row["length"], row["modified"]) == (read[row["path"]]["length"], read[row["path"]]["modificationTime"])


def test_files_are_written_one_by_one(spark, tmp_path):
    docs = spark.createDataFrame([("a/b.md", bytearray(b"x")), ("_c.md", None)], "path string, content binary")
    assert sinks.write_files(docs, str(tmp_path / "w")) == 2
    assert (tmp_path / "w" / "a" / "b.md").read_bytes() == b"x" and (tmp_path / "w" / "_c.md").read_bytes() == b""
    with pytest.raises(Exception, match="leads out"):
        sinks.write_files(spark.createDataFrame([("../x", bytearray(b"x"))], docs.schema), str(tmp_path / "w"))


def test_discovery_report(spark, tree):
    rows = d.discovery_report(spark, [str(tree / "note.txt"), str(tree / "a.adoc"), str(tree / "absent"), str(tree / "deep")])
    got = sorted((r["path"].rsplit("/", 1)[1], r["status"]) for r in rows.collect())
    assert got == [
        ("a.adoc", "supported"), ("absent", "missing"), ("b.pdf", "supported"),
        ("bad.adoc", "supported"), ("c.adoc", "supported"), ("note.txt", "unsupported"),
    ]


def test_nothing_found(spark, tmp_path):
    assert d.read_documents(spark, [str(tmp_path / "absent")]).count() == 0


def test_texts_have_line_feeds_only_and_errors(spark, tree):
    rows = {r["path"].rsplit("/", 1)[1]: r for r in d.read_texts(spark, [str(tree)]).collect()}
    assert rows["a.adoc"]["text"] == ":v: 4\n= A {v}\n"
    assert rows["bad.adoc"]["text"] is None
    assert rows["bad.adoc"]["error"] == "not valid UTF-8"


def test_read_markdown(spark, tmp_path):
    (tmp_path / "x.md").write_bytes(b"# x\r\n")
    assert d.read_markdown(spark, [str(tmp_path)]).first()["md"] == "# x\n"


@pytest.fixture
def fake_pdf():
    # Made in a function, so that it is shipped by value to the workers.
    def convert_pdf(path, content):
        if len(content) > 5:
            raise ValueError("too long")
        return f"# {path.rsplit('/', 1)[-1]} {len(content)}"

    return convert_pdf


def test_conversion_with_hook(spark, tree, fake_pdf):
    files = d.read_documents(spark, [str(tree)])
    rows = {r["path"].rsplit("/", 1)[1]: r for r in convert.convert_documents(files, {".pdf": fake_pdf}).collect()}
    assert rows["a.adoc"]["md"] == "\n# A 4\n"
    assert rows["c.adoc"]["md"] == "- é\n"
    assert rows["b.pdf"]["md"] == "# b.pdf 5"
    assert (rows["bad.adoc"]["md"], rows["bad.adoc"]["error"]) == (None, "not valid UTF-8")


def test_tree_is_converted_like_a_table(spark, tree, fake_pdf):
    table = convert.convert_documents(d.read_documents(spark, [str(tree)]), {".pdf": fake_pdf})
    of_tree = d.convert_tree(spark, [str(tree)], {".pdf": fake_pdf})
    assert sorted(map(str, of_tree.collect())) == sorted(map(str, table.collect()))
    assert names(d.convert_tree(spark, [str(tree)])) == ["a.adoc", "b.pdf", "bad.adoc", "c.adoc"]


def test_failing_hook_is_an_error_row(spark, fake_pdf):
    files = spark.createDataFrame([("a.pdf", bytearray(b"123456")), ("b.pdf", bytearray(b"1"))], "path string, content binary")
    good, bad = convert.split_converted(convert.convert_documents(files, {".pdf": fake_pdf}))
    assert [tuple(r) for r in good.collect()] == [("b.pdf", "# b.pdf 1")]
    assert [tuple(r) for r in bad.collect()] == [("a.pdf", "ValueError: too long")]


def test_unsupported_extension(spark):
    files = spark.createDataFrame([("a.TXT", bytearray(b"x"))], "path string, content binary")
    assert convert.convert_documents(files).first()["error"] == "Unsupported extension: .txt"


def test_report_and_written_outcome(spark, tree, tmp_path):
    converted = convert.convert_documents(d.read_documents(spark, [str(tree)]))
    report = {(r["ext"], r["status"]): r["n_docs"] for r in convert.conversion_report(converted).collect()}
    assert report == {(".adoc", "converted"): 2, (".adoc", "failed"): 1, (".pdf", "failed"): 1}
    path = str(tmp_path / "out")
    assert sinks.write_converted(converted, path) == {"found": 4, "converted": 2, "failed": 2}
    assert names(sinks.read_converted(spark, path)) == ["a.adoc", "c.adoc"]
    assert names(sinks.read_converted(spark, path, "failed")) == ["b.pdf", "bad.adoc"]


def test_all_failed_is_an_error(spark, tmp_path):
    files = spark.createDataFrame([("a.pdf", bytearray(b"x"))], "path string, content binary")
    with pytest.raises(ValueError, match="no document was converted"):
        sinks.write_converted(convert.convert_documents(files), str(tmp_path / "out"))
    with pytest.raises(ValueError, match="no document was converted"):
        sinks.write_converted(convert.convert_documents(files.limit(0)), str(tmp_path / "out2"))


def test_merged_corpus_files(spark, tmp_path):
    texts = [f"doc {i}\nend" for i in range(40)]
    docs = spark.createDataFrame([(f"p{i:03d}", t) for i, t in enumerate(texts)], "path string, md string").repartition(5)
    sinks.write_merged_corpus(docs, str(tmp_path / "m"))
    corpus = "".join(f.read_text(encoding="utf-8") for f in sorted((tmp_path / "m").glob("part-*")))
    assert corpus == "\n\n---\n\n".join(texts) + "\n"
    in_one = merge_documents(docs.selectExpr("int(substr(path, 2)) AS n", "'all' AS g", "md"), "g", "n")
    assert in_one.first()["md"] + "\n" == corpus


def test_documents_keep_their_rows(spark, tmp_path):
    docs = spark.createDataFrame([("a", "s1", "x"), ("b", "s2", "y")], "path string, source string, md string")
    sinks.write_documents(docs, str(tmp_path / "d"), ("source",))
    assert spark.read.parquet(str(tmp_path / "d")).where("source = 's2'").first()["md"] == "y"
