"""Bidiagonalisation and whitening against dense linear algebra."""

import math

import numpy as np
import pytest
from conftest import SF_DIR

from docloom.llm.whitening import bidiagonalise, whiten


def dense(rows, components=16):
    """Expected rows by the covariance matrix, in plain numpy and Python."""
    usable = [
        (i, [math.floor(64 * float(c)) + 1_000_000 for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    apart = [[n * a - s for a, s in zip(x, sums, strict=True)] for x in fit]
    centred = np.array(apart, dtype=float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    trace = float((centred**2).sum() / n)
    out = {}
    for i, x in usable:
        exact = [n * a - s for a, s in zip(x, sums, strict=True)]
        deviation = sum(d * d for d in exact)
        out[i] = (n, deviation, np.array(exact, dtype=float) / n @ vectors / np.sqrt(values), values / trace)
    return out


def compare(got, expected):
    table = {}
    for r in set(got):
        table.setdefault(r["vec_id"], []).append(r)
    assert set(table) == set(expected)
    signs = None
    for i, (n, deviation, white, explained) in expected.items():
        rows = sorted(table[i], key=lambda r: r["component"])
        assert [r["component"] for r in rows] == list(range(1, len(white) + 1))
        assert {(r["n"], r["deviation"]) for r in rows} == {(n, deviation)}
        found = np.array([r["whitened"] for r in rows])
        if signs is None:
            signs = np.sign(found * white)
        assert np.allclose(found * signs, white, atol=1e-8, rtol=1e-8)
        assert np.allclose([r["explained"] for r in rows], explained, rtol=1e-9)
        assert all(r["identity_error"] < 1e-9 for r in rows)


def test_whole_table(spark):
    embeddings = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    compare(whiten(embeddings).collect(), dense([(r["vec_id"], r["embedding"]) for r in embeddings.collect()]))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    r = np.random.default_rng(5)
    rows = [(i, r.normal(0, [3, 1, 0.5], 3).round(3).tolist()) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(7, rows[7][1])]
    odd = [(200, None), (201, []), (202, [1.0, nan, 0.0]), (203, [1.0, None, 0.0]), (204, [inf, 0.0, 0.0]), (205, [1.0])]
    frame = spark.createDataFrame(
        [(*row, 1.5, "x") for row in rows + odd], "vec_id long, embedding array<double>, whitened double, x string"
    )
    got = whiten(frame).collect()
    assert len(got) == 3 * len(rows)
    compare(got, dense(rows))
    one = frame.where("vec_id < 0")
    assert whiten(one).count() == 0 and whiten(one).columns == whiten(frame).columns
    assert whiten(frame.where("vec_id >= 100 AND vec_id < 130")).count() == 0
    assert {tuple(x) for x in whiten(frame.where("vec_id = 0 OR vec_id = 1")).select("component").collect()} == {(1,)}


def test_large_entries(spark):
    frame = spark.createDataFrame([(1, [1e9, 1.0]), (2, [1.0, -1e300]), (3, [0.0, 0.5])], "vec_id long, embedding array<double>")
    got = {(r["vec_id"], r["component"]): r for r in whiten(frame).collect()}
    assert len(got) == 6 and got[2, 1]["deviation"] is None
    whole = [[64 * 10**9, 64], [64, -(1 << 52)], [0, 32]]
    sums = [sum(c) for c in zip(*whole, strict=True)]
    exact = sum((3 * a - s) ** 2 for a, s in zip(whole[2], sums, strict=True))
    assert got[3, 1]["deviation"] == (exact if exact < 1 << 63 else None)


@pytest.mark.parametrize("kind", ["random", "repeated", "flat", "zero", "graded"])
def test_bidiagonalisation(kind):
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 12))
    if kind == "repeated":
        u, _, v = np.linalg.svd(x, full_matrices=False)
        x = u @ np.diag([9, 9, 9, 5, 5, 4, 3, 2, 1, 1, 1, 1.0]) @ v
    elif kind == "flat":
        x = x[:, :4] @ r.normal(size=(4, 12))
    elif kind == "zero":
        x = x * 0
    elif kind == "graded":
        x = x * 10.0 ** -np.arange(12)
    passes = []

    def product(w):
        left = x @ w
        passes.append(1)
        return left @ x, float(left @ left)

    vectors, values = bidiagonalise(product, 12)
    expected = np.linalg.svd(x)[1]
    assert np.allclose(values, expected, atol=1e-13 * max(expected[0], 1))
    assert np.allclose(vectors.T @ vectors, np.eye(12), atol=1e-13)
    assert np.allclose(x.T @ x @ vectors, vectors * values**2, atol=1e-11 * max(expected[0] ** 2, 1))
    assert len(passes) <= 36
