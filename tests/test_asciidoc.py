import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import asciidoc as a
from docloom.operators.convert import shared_attributes


def entries(value, text, **options):
    return [(e["name"], e["value"]) for e in value(lambda c: a.attribute_entries(c, (), **options), text)]


def test_defaults_come_first_and_own_value_wins(value):
    got = [(e["name"], e["value"]) for e in value(a.attribute_entries, ":kebab: own\n:new: n\n")]
    assert [name for name, _ in got] == [
        "product-title", "product-version", "VirtProductName", "op-system-base-full", "op-system-base", "kebab", "new",
    ]
    assert dict(got)["kebab"] == "own"
    assert dict(got)["product-version"] == ""


def test_first_place_last_value(value):
    assert entries(value, ":a: 1\n:b: 2\n:a: 3\n") == [("a", "3"), ("b", "2")]


def test_definition_needs_line_start_and_letter(value):
    assert entries(value, " :a: 1\n:1b: 2\nx :c: 3\n:ok:  spaced \t\n:!un: x\n") == [("ok", "spaced")]


def test_empty_value_stays_on_its_line_by_default(value):
    text = ":toc:\n\n:a: 1\n"
    assert entries(value, text) == [("toc", ""), ("a", "1")]
    assert entries(value, text, across_lines=True) == [("toc", ":a: 1")]


def test_substitution_is_one_pass_in_order(value):
    # {b} in a's value is resolved because b comes later; {a} in b's is not.
    assert value(a.clean_asciidoc, ":a: x{b}\n:b: y{a}\nsee {a} {b}").endswith("see xy y")


def test_references_are_filled_as_if_in_turn(spark):
    """Nested, open, empty and adjacent braces, in lines and in values, against
    a plain loop of replacements over the entries."""
    r = random.Random(11)
    plain = ["{a}", "{b}", "{c}", "{a-b}", "{é}", "x", "{}", "{zz}", " ", "{d}"]
    odd = [*plain, "{", "}", "{{a}}", "{a{b}}", "a", "b"]
    rows = []
    for i in range(600):
        pieces = odd if i % 3 == 0 else plain
        names = r.sample(["a", "b", "c", "d", "a-b", "ab", "ax", "é", ""], r.randrange(0, 9))
        known = [(name, "".join(r.choices(pieces, k=r.randrange(0, 5)))) for name in names]
        lines = ["".join(r.choices(odd if i % 2 else plain, k=r.randrange(0, 7))) for _ in range(r.randrange(1, 4))]
        expected = "\n".join(lines)
        for name, new in known:
            expected = expected.replace("{" + name + "}", new)
        rows.append((known, "\n".join(lines), expected))
    docs = spark.createDataFrame(rows, "known array<struct<name:string,value:string>>, text string, expected string")
    for few in (0, 4, a.FEW_ATTRIBUTES):
        got = a.substitute_attributes(F.col("text"), F.col("known"), few)
        assert docs.where(~got.eqNullSafe(F.col("expected"))).collect() == []


def test_newest_values_in_first_places(spark):
    r = random.Random(12)
    rows = [([(r.choice("abcé"), str(r.random())) for _ in range(r.randrange(0, 12))],) for _ in range(200)]
    docs = spark.createDataFrame(rows, "given array<struct<name:string,value:string>>")
    for row in docs.select("given", a._newest(F.col("given")).alias("newest")).collect():
        assert list(map(tuple, row["newest"])) == list(dict(map(tuple, row["given"])).items())


def test_thousands_of_definitions(value):
    count = 4_000
    definitions = [f":n-{i}: v{i}{{n-{i + 1}}}" if i % 2 else f":n-{i}: v{i}" for i in range(count)]
    text = "\n".join([*definitions, *[f"see {{n-{i}}} {{none}}" for i in range(count)]])
    lines = value(a.clean_asciidoc, text).split("\n")[count:]
    # The last odd name refers to one that is not defined.
    end = [f"see v{count - 1} "]
    assert lines == [f"see v{i}v{i + 1} " if i % 2 else f"see v{i} " for i in range(count - 1)] + end


def test_last_definition_counts_before_it_too(value):
    assert value(a.clean_asciidoc, "{v}\n:v: 1\n:v: 2\n") == "2\n\n\n"


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("a {unknown} b", "a  b"),
        ("include::x.adoc[]\nkept\n include::y[]", "\nkept\n include::y[]"),
        # Blank lines behind the id go; the last line feed stays.
        ('[id="s_1"]\n\n\n== T\n', "\n== T\n"),
        ('[id="s_{context}"]\n== T', "\n== T"),
        ('x [id="s"]\n', 'x [id="s"]\n'),
        ("ifdef::a[]\nbody\nendif::[]\nifndef::b[]\nx", "\nbody\n\n\nx"),
        (":name: value\n:a-b: c\n:not a definition\n::", "\n\n:not a definition\n::"),
        ("{op-system-base} {kebab}", "RHEL &#8942;"),
        ("", ""),
    ],
)
def test_clean_asciidoc(value, raw, expected):
    assert value(a.clean_asciidoc, raw) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("= T\n== A\n====== F\n======= no\n=x", "# T\n## A\n###### F\n======= no\n=x"),
        ("* a\n** b\n*** c\n*bold* x", "- a\n  - b\n    - c\n*bold* x"),
        (". a\n.. b\n.Title", "1. a\n   1. b\n.Title"),
        ("link:a.html[A b], link:b.html[]", "[A b](a.html), <b.html>"),
        ("(https://x.org/a[X]) http://y.org[] image:https://z.org[i]", "([X](https://x.org/a)) <http://y.org> image:https://z.org[i]"),
        ("http://a.b[c]http://a.b[d]", "[c](http://a.b)[d](http://a.b)"),
        ("* see link:a[b]", "- see [b](a)"),
        ("a\n----\n* x\n= y\n----\n* z", "a\n```\n* x\n= y\n```\n- z"),
        ("[source,bash]\n----\nls\n----\n", "```bash\nls\n```\n"),
        ("[source,yaml,subs=+quotes]\n-----\nk: v\n-----", "```yaml\nk: v\n```"),
        # Inside a listing a source line is code, and the dashes close it.
        ("----\n[source,c]\n----\n[source,d]\nx", "```\n[source,c]\n```\n[source,d]\nx"),
        ("----\nnever closed", "```\nnever closed\n```"),
        ("a -- b --- c", "a -- b --- c"),
        # A block closes with marks of its own kind and length only.
        ("----\na\n------\n....\n* b\n----\n* c", "```\na\n------\n....\n* b\n```\n- c"),
        ("......\n* a\n....\n----\n......\n----\n= b\n----", "```\n* a\n....\n----\n```\n```\n= b\n```"),
        ("x\n////\n* gone\n----\n/////\n////\n* y", "x\n\n- y"),
        ("....\n* no partner\n////\n* nor here", "....\n- no partner\n////\n- nor here"),
        ("----\n```\n````x\n----", "`````\n```\n````x\n`````"),
        ("******* deep\n....... d", "            - deep\n                  1. d"),
        ("|===\n|A |B\n\n|one\n|two\nlines\n|a\\|b |https://x.org[X]\n|===\n* z",
         "| A | B |\n| --- | --- |\n| one | two lines |\n| a\\|b | [X](https://x.org) |\n- z"),
        ('.T\n[cols="1,2"]\n|===\n|a\n|b\n|c\n|===', ".T\n| a | b |\n| --- | --- |\n| c |"),
        ('[%header,cols="3*"]\n|====\n|a |b |c |d\n|===\n|====', "| a | b | c |\n| --- | --- | --- |\n| d | === |"),
        ("|===\n|===", "|===\n|==="),
        ("image::a/b.png[An image,200]\nimage::c.png[]", "![An image](a/b.png)\n![](c.png)"),
        ("see xref:a.adoc#b[A part], xref:c[C], <<id>> and <<id, text>>", "see [A part](a.adoc#b), [C](#c), [id](#id) and [text](#id)"),
        ("* <<x>> link:a[b]", "- [x](#x) [b](a)"),
        ("", ""),
    ],
)
def test_markdown_subset(value, raw, expected):
    assert value(a.asciidoc_to_markdown, raw) == expected


def test_very_long_blocks(value):
    lines = "* x\n-----\n....\n" * 100_000
    assert value(a.asciidoc_to_markdown, f"----\n{lines}----\n* y") == f"```\n{lines}```\n- y"
    assert value(a.asciidoc_to_markdown, f"----\n{lines}") == f"```\n{lines}```"
    rows = "".join(f"|{i} |b\n" for i in range(20_000))
    table = value(a.asciidoc_to_markdown, f"|===\n{rows}|===").split("\n")
    assert len(table) == 20_001 and table[-1] == "| 19999 | b |"


def test_attributes_do_not_leak_between_documents(spark):
    docs = spark.createDataFrame([(1, ":x: one\n{x}"), (2, "{x}")], "id int, text string")
    rows = {r["id"]: r["t"] for r in docs.select("id", a.clean_asciidoc(F.col("text")).alias("t")).collect()}
    assert rows == {1: "\none", 2: ""}


def cleaned(docs, table):
    known = shared_attributes(docs, table, "id").select("id", a.clean_asciidoc(F.col("text"), F.col("attributes")).alias("t"))
    return {r["id"]: r["t"] for r in known.collect()}


def test_shared_attributes(spark):
    docs = spark.createDataFrame([(1, ":y: own\n{x} {y} {kebab}"), (None, "{x}"), (3, None), (4, "")], "id int, text string")
    pairs = [("x", "shared"), ("y", "other"), ("kebab", "K"), ("x", "a"), (None, "n"), ("n", None)]
    table = spark.createDataFrame(pairs, "name string, value string")
    assert cleaned(docs, table) == {1: "\nshared own K", None: "shared", 3: None, 4: ""}
    assert cleaned(docs.limit(0), table) == {}
    assert cleaned(docs, table.limit(0))[1] == "\n own &#8942;"
    broken = spark.createDataFrame([("x", "a\nb")], "name string, value string")
    with pytest.raises(ValueError, match="one line"):
        shared_attributes(docs, broken, "id")


def test_shared_attributes_of_any_number_and_depth(spark):
    """Each refers to the next one by name, the last one back to the first."""
    table = spark.range(3000).selectExpr("format_string('c%04d', id) AS name", "concat(id % 10, format_string('{c%04d}', (id + 1) % 3000)) AS value")
    docs = spark.createDataFrame([(1, "{c2990}"), (2, ":c2995: mine\n{c2990}"), (3, "{c9999}")], "id int, text string")
    # A value is resolved by later names only; one's own definitions come last
    # in order unless a shared row had the name before.
    assert cleaned(docs, table.where("name >= 'c2990'")) == {1: "0123456789", 2: "\n01234mine", 3: ""}
    one = docs.where("id < 3")
    assert cleaned(one, table.where("name >= 'c2985' OR name < 'c0003'")) == {1: "0123456789", 2: "\n01234mine"}
