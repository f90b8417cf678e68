import json

import pytest

from docloom.plans.training_set import Settings, build_training_set


def test_documents_to_chat_rows(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.adoc").write_text(":p: Loom\n= About {p}\n\nIt weaves. It is fast.\n", encoding="utf-8")
    (docs / "b.adoc").write_text(":p: Loom\n= About {p}\n\nIt weaves. It is fast.\n", encoding="utf-8")
    (docs / "c.adoc").write_text("== Other\n\nOne fact é", encoding="utf-8")
    (docs / "d.pdf").write_bytes(b"%PDF")
    target = str(tmp_path / "out")
    settings = Settings(domain="Loom", system_prompt="Be brief.")
    counts = build_training_set(spark, [str(docs)], target, settings)
    # b repeats a; "# About Loom", two sentences, "## Other", one fact: two rows each.
    assert counts == {"found": 4, "converted": 3, "failed": 1, "rows": 10, "examples": 10}
    lines = [x for f in (tmp_path / "out" / "train").glob("part-*") for x in f.read_text(encoding="utf-8").splitlines()]
    messages = [json.loads(line)["messages"] for line in lines]
    assert {m[0]["content"] for m in messages} == {"Be brief."}
    assert {"It weaves", "One fact é"} <= {m[2]["content"] for m in messages}
    resumed = build_training_set(spark, [str(docs)], target, settings, resume=True)
    assert resumed == {"rows": 10, "examples": 10}


def rows_of(target):
    lines = [x for f in (target / "train").glob("part-*") for x in f.read_text(encoding="utf-8").splitlines()]
    return sorted(lines)


def tree(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.adoc").write_text(text, encoding="utf-8")
    return str(folder)


def test_resume_equals_a_fresh_run(spark, tmp_path):
    """Other tree, added, changed and removed files, other settings."""
    target = tmp_path / "out"

    def check(inputs, settings):
        build_training_set(spark, [inputs], str(target), settings, resume=True)
        fresh = tmp_path / f"fresh{len(list(tmp_path.iterdir()))}"
        build_training_set(spark, [inputs], str(fresh), settings)
        assert rows_of(target) == rows_of(fresh)

    one, two = Settings(domain="Loom"), Settings(domain="Wool", max_chars=40)
    a = tree(tmp_path / "a", x="= X\n\nOne fact.\n", y="= Y\n\nOther fact.\n")
    check(a, one)
    tree(tmp_path / "a", z="= Z\n\nAdded fact.\n", x="= X\n\nA fact that changed.\n")
    check(a, one)
    (tmp_path / "a" / "y.adoc").unlink()
    check(a, one)
    check(a, two)
    check(a, one)
    check(tree(tmp_path / "b", x="= X\n\nFrom the other tree.\n"), one)


def test_failed_conversions_are_tried_again(spark, tmp_path):
    inputs = tmp_path / "docs"
    inputs.mkdir()
    (inputs / "d.pdf").write_bytes(b"%PDF")
    target = str(tmp_path / "out")

    def broken(path, content):
        raise OSError("no reader")

    def working(path, content):
        return "# From PDF\n\nIts fact."

    with pytest.raises(ValueError, match="no document was converted"):
        build_training_set(spark, [str(inputs)], target, converters={".pdf": broken})
    counts = build_training_set(spark, [str(inputs)], target, converters={".pdf": working}, resume=True)
    assert counts["converted"] == 1 and counts["examples"] == counts["rows"] > 0


def test_shared_attributes_reach_the_documents(spark, tmp_path):
    inputs = tree(tmp_path / "s", x="= X {brand}\n\n{brand} weaves.\n", y="= Y\n\n:brand: Own\n{brand} knits.\n")

    def answers(value, target, resume):
        shared = spark.createDataFrame([("brand", value)], "name string, value string")
        build_training_set(spark, [inputs], str(target), Settings(), resume=resume, shared=shared)
        return "".join(rows_of(target))

    first = answers("Loom", tmp_path / "out", False)
    assert "Loom weaves" in first and "Own knits" in first
    changed = answers("Wool", tmp_path / "out", True)
    assert "Wool weaves" in changed and "Loom" not in changed and "Own knits" in changed
