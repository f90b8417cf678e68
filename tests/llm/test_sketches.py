"""Bottom-k fingerprints against sets in plain Python."""

import hashlib
import random

import pytest
from odd_tables import no_docs, odd_docs, prose  # noqa: F401
from pyspark.sql import functions as F

from docloom.llm import sketches

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = [w.decode() for w in (text or "").translate(FOLD).encode().split()]
    runs = [words[i : i + 5] for i in range(max(1, len(words) - 4))] if words else []
    return {hashlib.md5(" ".join(run).encode()).hexdigest()[:16] for run in runs}


def bottom(text, k=128):
    return sorted(shingles(text))[:k]


def alike(a, b, k=128):
    a, b = bottom(a, k), bottom(b, k)
    union = sorted({*a, *b})
    if len(a) == k or len(b) == k:
        union = union[:k]
    return len(set(a) & set(b) & set(union)) / len(union) if union else 1.0


def edits(rows):
    """Rows of ``(id, text)`` with their edited text and the next text."""
    first = {}
    for i, text in sorted((r[0], r[1] or "") for r in rows if r[0] is not None):
        first.setdefault(i, text)
    order = sorted(first)
    for i, text in rows:
        text = text or ""
        after = None if i is None else first[order[(order.index(i) + 1) % len(order)]]
        cut = len(text) // 4
        yield i, text, None if i is None else text[: len(text) - cut] + after[:cut], after


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = [
        (
            i, len(text), edited, "".join(bottom(text)), None if i is None else "".join(bottom(edited)),
            None if i is None else alike(text, edited), None if i is None else alike(text, after),
        )
        for i, text, edited, after in edits(rows)
    ]
    got = [tuple(r) for r in sketches.edited_fingerprints(docs).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_edits_of_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert sketches.edited_fingerprints(no_docs).count() == 0


def test_edits_of_ties_and_sparse_ids(spark):
    r = random.Random(3)
    rows = [(r.choice([-(10**12), 5, 6, 7, 10**15]), prose(r.randrange(9), r.randrange(700))) for _ in range(30)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    check(spark.createDataFrame([(3, "a b c d e f g h")], "doc_id long, text string"))


@pytest.mark.parametrize("shared", [0, 400, 1500, 2000])
def test_estimates(spark, shared):
    a = [f"w{i}" for i in range(2000)]
    b = a[:shared] + [f"v{i}" for i in range(2000 - shared)]
    frame = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string")
    prints = frame.select(*[sketches.fingerprint(F.col(c), k=512).alias(c) for c in "ab"])
    got = prints.select(
        sketches.resemblance(F.col("a"), F.col("b"), 512),
        sketches.containment(F.col("a"), F.col("b"), 512),
        sketches.distinct_shingles(F.col("a"), 512),
    ).first()
    sa, sb = shingles(" ".join(a)), shingles(" ".join(b))
    assert got[0] == pytest.approx(len(sa & sb) / len(sa | sb), abs=0.08)
    assert got[1] == pytest.approx(len(sa & sb) / len(sa), abs=0.1)
    assert got[2] == pytest.approx(len(sa), rel=0.15)


def test_merged_parts_are_the_whole(spark):
    texts = [prose(i % 40, 30 + i) for i in range(200)] + ["", None, "one two"]
    rows = [(["hot", "b", None][min(i % 9, 2)] if i else "empty", t if i else None) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "source string, text string")
    prints = frame.select("source", sketches.fingerprint(F.col("text")).alias("fingerprint"))
    merged = dict(tuple(r) for r in sketches.merged_fingerprints(prints, ["source"]).collect())
    for source in {s for s, _ in rows}:
        union = set().union(*[shingles(t) for s, t in rows if s == source])
        assert merged[source] == "".join(sorted(union)[:128])


def test_no_python_in_the_plan(odd_docs):
    plan = sketches.edited_fingerprints(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
