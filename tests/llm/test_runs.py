"""Periodic runs against a search by definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_tables import no_docs, odd_docs  # noqa: F401

from docloom.llm import queries, runs


def by_definition(words, periods=4, length=6):
    """Maximal stretches of every period, smallest period first."""
    n, found = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(periods * q, length):
                found.setdefault((start, i + q), q)
    return sorted((start, end - start, q) for (start, end), q in found.items())


def found_in(texts, **options):
    words = [w for t in texts for w in t]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    offsets = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    got = runs.find_runs(np.array([numbers[w] for w in words], dtype=np.int64), offsets, **options)
    out = [[] for _ in texts]
    for t, *run in zip(*(v.tolist() for v in got), strict=True):
        out[t].append(tuple(run))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), max_size=6), st.sampled_from([(4, 6), (2, 2), (2, 5), (3, 1)]))
def test_small_alphabets(texts, least):
    options = {"periods": least[0], "length": least[1]}
    assert found_in(texts, **options) == [by_definition(t, *least) for t in texts]


@pytest.mark.parametrize("seed", range(8))
def test_repeats_of_repeats(seed):
    r = random.Random(seed)

    def piece(depth):
        part = [r.choice("abcd") for _ in range(r.randrange(1, 4))] if not depth else piece(depth - 1) + piece(0)
        return part * r.randrange(1, 8) + part[: r.randrange(len(part))]

    texts = [piece(2) for _ in range(20)] + [["a"] * k for k in range(12)] + [["a", "b"] * 40 + ["a"] * 9]
    texts += [texts[0], texts[0][::-1]]
    assert found_in(texts) == [by_definition(t) for t in texts]


def test_one_word_many_times():
    assert found_in([["x"] * 100_000, [], ["y"] * 5]) == [[(0, 100_000, 1)], [], []]


def expected_rows(rows):
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        n = len(words)
        h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found = by_definition(words)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        yield (
            doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
        )


@pytest.mark.parametrize("batch", [1 << 12, 1 << 20])
def test_query(spark, monkeypatch, batch):
    monkeypatch.setattr(runs, "BATCH_BYTES", batch)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    rows = [(i, t) for i, t in rows if len((t or "").split()) < 3000]
    got = {tuple(r) for r in queries.op11_periodic_runs(spark, SF_DIR).collect()}
    assert {r[0] for r in got} >= {i for i, _ in rows}
    expected = set(expected_rows(rows))
    assert expected <= got and any(r[1] for r in expected)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(odd_docs).collect()]
    assert len(rows) == odd_docs.count()
    for (doc_id, n, found, collapsed), row in zip(rows, odd_docs.collect(), strict=True):
        words = (row["text"] or "").encode().split()
        assert (doc_id, n) == (row["doc_id"], len(words))
        if n < 100:
            assert not found and collapsed.encode() == b" ".join(words)
    assert runs.periodic_runs(no_docs).count() == 0
    frame = spark.createDataFrame([(1, "go " * 7 + "on"), (1, "a b " * 5), (None, "é é " * 6)], "doc_id long, text string")
    assert [tuple(r)[1:] for r in runs.periodic_runs(frame).collect()] == [
        (8, [(0, 7, 1)], "go on"), (10, [(0, 10, 2)], "a b"), (6, [(0, 6, 1)], "é é"),
    ]
    rows = [(0, None), (40, ""), (None, "a " * 9)]
    planted = queries.with_planted_periods(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [tuple(r) for r in planted.collect()] == rows
