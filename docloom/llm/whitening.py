"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

``X`` has a row for every distinct vector of the fit list, centred: entries
are whole numbers ``x``, and ``n * x - S`` (``S`` the sum per dimension) is
exact, so a centred entry is right to the last bit.

A step multiplies ``X`` by a right vector and its transpose by the left
vector that comes out of it.  Left vectors are as long as the fit list and are
never kept: each is ``X w`` for a short ``w``, made again where it is needed,
and its inner product with another one ``X w'`` is ``w' . X'(X w)``, of which
a pass returns the last factor.  So both sides are reorthogonalised in full
with vectors no longer than an embedding, and a pass over the blocks needs
nothing that an executor would have to remember.  The singular value
decomposition of the small bidiagonal matrix gives components and deviations.

A pass sends one number per dimension and task through a grouped sum; the
driver holds a few matrices as large as the square of an embedding's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.tables import saved

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Entries beyond this are taken as this: doubles count by ones up to here.
LARGEST = 1 << 52

_EPS = float(np.finfo(float).eps)


class Whitening(NamedTuple):
    """Components in columns, with their eigenvalues, largest first."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def whole_vectors(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET
) -> DataFrame:
    """``vec_id, x``: ``floor(scale * c) + offset`` of every entry, but for
    vectors that are null, empty or hold a null or non-finite entry."""
    numbers = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.forall(numbers, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = embeddings.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(finite)

    def whole(c):
        bounded = F.greatest(F.least(F.floor(c * scale).cast("double"), F.lit(float(LARGEST))), F.lit(float(-LARGEST)))
        return bounded.cast("long") + offset

    return usable.select(F.col(key).cast("long").alias("vec_id"), F.transform(numbers, whole).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("x"))
            yield pa.record_batch(
                [pa.array([len(x)]), pa.array([x.tobytes()], pa.binary())], names=["count", "block"]
            )


def _reach(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)


def _sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns."""
    return x.sum(axis=0) if _reach(x) * len(x) < 1 << 62 else x.astype(object).sum(axis=0)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``, exact; Python numbers where 64 bits do not do."""
    if n * _reach(x) >= 1 << 62 or max(map(abs, sums.tolist())) >= 1 << 62:
        return x.astype(object) * n - sums
    return x * np.int64(n) - sums.astype(np.int64)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (_deviations(x, n, sums) / n).astype(float)


class _Fit:
    """The fit list as blocks in the shared folder, and passes over them."""

    def __init__(self, vectors: DataFrame, dim: int):
        self.dim = dim
        blocks = vectors.select("x").distinct().mapInArrow(_packed, "count long, block binary")
        self.blocks = saved(blocks, "whitening-fit")
        self.n = int(self.blocks.agg(F.sum("count")).first()[0])
        sums = self._rows(lambda x: {0: _sums(x)}, exact=True)
        self.sums = np.array([sums[0, i] for i in range(dim)], dtype=object)

    def _rows(self, part, exact: bool = False) -> dict[tuple[int, int], float]:
        """Sums over all blocks of what ``part`` makes of one: named lists."""
        dim = self.dim
        kind = pa.decimal128(38, 0) if exact else pa.float64()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict = {}
            for batch in batches:
                for block in batch.column("block"):
                    x = np.frombuffer(block.as_py(), np.int64).reshape(-1, dim)
                    for name, values in part(x).items():
                        values = np.asarray(values, dtype=object if exact else float)
                        totals[name] = totals[name] + values if name in totals else values
            for name, values in totals.items():
                listed = values.tolist()
                yield pa.record_batch(
                    [
                        pa.array([name] * len(listed), pa.int32()),
                        pa.array(range(len(listed)), pa.int32()),
                        pa.array([Decimal(int(v)) for v in listed] if exact else listed, kind),
                    ],
                    names=["name", "i", "value"],
                )

        schema = f"name int, i int, value {'decimal(38,0)' if exact else 'double'}"
        summed = self.blocks.select("block").mapInArrow(run, schema).groupBy("name", "i").agg(F.sum("value").alias("v"))
        return {(r["name"], r["i"]): int(r["v"]) if exact else r["v"] for r in summed.collect()}

    def product(self, w: np.ndarray) -> tuple[np.ndarray, float]:
        """``X'(X w)`` and the squared length of ``X w``."""
        n, sums, dim = self.n, self.sums, self.dim

        def part(x: np.ndarray) -> dict:
            centred = _centred(x, n, sums)
            left = centred @ w
            return {0: left @ centred, 1: [left @ left]}

        found = self._rows(part)
        return np.array([found[0, i] for i in range(dim)]), float(found[1, 0])

    def squares(self) -> float:
        n, sums = self.n, self.sums
        return float(self._rows(lambda x: {0: [(_centred(x, n, sums) ** 2).sum()]})[0, 0])

    def whitened_moments(self, white: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and sum of outer products of the whitened rows."""
        n, sums, k = self.n, self.sums, white.shape[1]

        def part(x: np.ndarray) -> dict:
            y = _centred(x, n, sums) @ white
            return {0: y.sum(axis=0), 1: (y.T @ y).ravel()}

        found = self._rows(part)
        total = np.array([found[0, i] for i in range(k)])
        return total, np.array([found[1, i] for i in range(k * k)]).reshape(k, k)


def _clean(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """A vector less its parts along an orthonormal basis, twice over."""
    for _ in range(2):
        for other in basis:
            vector = vector - (other @ vector) * other
    return vector


def bidiagonalise(product, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """``V, s``: all right singular vectors in columns and their singular
    values, falling, of an ``X`` known by ``product(w) -> X'Xw, |Xw|^2``.

    Takes ``dim`` steps, whatever the values: an end at the first values that
    stand still could miss repeated ones.  Where a vector vanishes the
    recurrence starts again with one orthogonal to all before.
    """
    random = np.random.default_rng(7)
    rights: list[np.ndarray] = []
    lefts: list[tuple[np.ndarray, np.ndarray]] = []  # w and X'Xw of every left vector Xw
    alphas: list[float] = []
    betas: list[float] = []
    largest = beta = 0.0
    right = random.standard_normal(dim)
    right /= np.linalg.norm(right)
    while True:
        rights.append(right)
        w = right - beta * lefts[-1][0] if beta else right
        for _ in range(3):
            back, square = product(w)
            largest = max(largest, np.sqrt(square))
            # Inner products of Xw with the earlier left vectors.
            along = [float(other_back @ w) for _, other_back in lefts]
            for part, (other, other_back) in zip(along, lefts, strict=True):
                w, back = w - part * other, back - part * other_back
            # Subtracting from the products is as good as a new pass as long
            # as little is subtracted.
            if sum(part * part for part in along) <= 1e-16 * square:
                break
        alpha = float(np.sqrt(square))
        if alpha <= _EPS * dim * largest:
            alpha, left = 0.0, (np.zeros(dim), np.zeros(dim))
        else:
            left = (w / alpha, back / alpha)
        alphas.append(alpha)
        lefts.append(left)
        if len(rights) == dim:
            _, values, small = np.linalg.svd(_bidiagonal(alphas, betas))
            return np.array(rights).T @ small.T, values
        following = _clean(left[1], rights)
        beta = float(np.linalg.norm(following))
        if beta <= _EPS * dim * largest:
            beta, following = 0.0, _clean(random.standard_normal(dim), rights)
        betas.append(beta)
        right = _clean(following / np.linalg.norm(following), rights)
        right /= np.linalg.norm(right)


def _bidiagonal(alphas: list[float], betas: list[float]) -> np.ndarray:
    small = np.diag(alphas)
    for i, beta in enumerate(betas):
        small[i, i + 1] = beta
    return small


def fit_whitening(vectors: DataFrame, dim: int, components: int = COMPONENTS) -> tuple[Whitening, _Fit]:
    """Components of the distinct ``x`` of ``vectors(x)``, all of one length."""
    fit = _Fit(vectors, dim)
    wanted = min(components, dim)
    basis, values = bidiagonalise(fit.product, dim)
    total = fit.squares()
    kept = int(np.sum(values[:wanted] > _EPS * dim * max(values[0], 1e-300))) if total > 0 else 0
    basis, values = basis[:, :kept], values[:kept]
    basis = basis / np.linalg.norm(basis, axis=0)
    basis = basis * np.sign(basis[np.abs(basis).argmax(axis=0), range(kept)])
    eigenvalues = values**2 / fit.n
    explained = values**2 / total if kept else values
    return Whitening(fit.n, [int(s) for s in fit.sums], basis, eigenvalues, explained), fit


_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, **options) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``
    for every usable row of ``embeddings`` and every component.

    Vectors that are null, empty or hold a null or non-finite entry are left
    out, and so are those whose length is not the commonest one (of equally
    common ones the shortest): components belong to one length.  An entry
    beyond 2 ** 52 counts as 2 ** 52.  Rows that repeat an id or a vector all
    come out; the fit has each vector once.  There are as many components as
    the fitted vectors span dimensions, at most ``components``, and none if all
    are equal.  A ``deviation`` that does not fit a long is null.  Other columns
    are ignored; an empty table gives no rows.
    """
    vectors = whole_vectors(embeddings, **options)
    lengths = vectors.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    spark = embeddings.sparkSession
    if lengths is None:
        return spark.createDataFrame([], _OUT)
    dim = lengths["dim"]
    vectors = vectors.where(F.size("x") == dim)
    model, fit = fit_whitening(vectors, dim, components)
    k = len(model.eigenvalues)
    if not k:
        return spark.createDataFrame([], _OUT)
    white = model.components / np.sqrt(model.eigenvalues)
    total, outer = fit.whitened_moments(white)
    covariance = outer / model.n - np.outer(total / model.n, total / model.n)
    error = float(np.abs(covariance - np.eye(k)).max())
    sums = np.array(model.sums, dtype=object)
    n, explained = model.n, model.explained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = _deviations(_matrix(batch.column("x")), n, sums)
            whitened = (apart / n).astype(float) @ white
            if apart.dtype == object or float(np.abs(apart).max()) ** 2 * dim >= 2.0**62:
                squares = (apart.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([v if v < 1 << 63 else None for v in squares.tolist()], pa.int64())
            else:
                deviation = pa.array((apart**2).sum(axis=1))
            rows = np.repeat(np.arange(batch.num_rows), k)
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(rows), n)),
                    deviation.take(pa.array(rows)),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, batch.num_rows)),
                    pa.array(np.full(len(rows), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(run, _OUT)
