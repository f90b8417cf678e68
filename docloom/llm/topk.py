"""Exact top-k search by inner product without random access.

Vectors and queries meet in the cells of a grid: a row of cells has a share of
the vectors, a column a share of the queries.  A task holds the queries of its
cell, with the best of each so far, and reads the vectors past them, one block
after another, so that neither what it holds nor what it returns grows with
the vectors.  No table is broadcast or joined.

A block has a sorted list of every component.  A list is read from its high
end if the query's component is positive and from its low end if it is
negative, all lists to the same depth.  What was read of a vector and the value
where its unread lists stand bound its score from above; with the far ends of
the lists instead, from below.  Reading stops when no more vectors than a share
of the block can still beat the k-th best score so far, or, where there are not
so many scores yet, the k-th best lower bound (or all is read), and only those
are resolved to final scores.

At one depth, a list shows ``max(x, value at that depth)`` from its high end,
whatever the query, so the bounds of a whole pack are matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from docloom.llm.tables import saved

K = 5
SCALE = 256
EVERY = 50
#: Vectors in a block, or numbers if those are reached first, and queries that
#: read it at once.
BLOCK = 4096
NUMBERS = 1 << 20
PACK = 256
#: Depths of reading as shares of a block, and the share of a block that may
#: be left to resolve.
DEPTHS = (0.125, 0.5, 1.0)
RESOLVED = 1 / 64
#: Blocks after which a pack of queries tries the smaller depths again.
RETRY = 16
#: Bytes of numbers in a row of packed vectors, vectors (or queries, if there
#: are more) for a cell, cells that smaller tables have as well if each gets
#: some blocks, and bytes of queries that a cell may hold on average.
ROW_BYTES = 2048
SHARE = 1 << 17
FEW = 24
HELD = 64 << 20

_PACKED = "dim int, width int, n int, ids binary, parts binary"


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, dim, parts``: ``floor(scale * x)`` of every component, for
    vectors that have an id and finite components only; equal rows once."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(finite)
    return usable.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.size("embedding").alias("dim"),
        F.transform(numbers, lambda x: F.floor(x * scale)).alias("parts"),
    ).distinct()


def _largest(x: np.ndarray) -> float:
    return max(float(x.max(initial=0)), -float(x.min(initial=0)))


def _width(x: np.ndarray) -> int:
    """Bytes of the smallest integers that hold all numbers."""
    low, high = x.min(initial=0), x.max(initial=0)
    return next(w for w in (1, 2, 4, 8) if np.iinfo(f"i{w}").min <= low and high <= np.iinfo(f"i{w}").max)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of the same length, some to a row, as bytes."""
    for batch in batches:
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        flat = batch.column("parts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(dims, dtype=np.int64) - dims
        rows = []
        for dim in np.unique(dims).tolist():
            own = np.flatnonzero(dims == dim)
            x = flat[starts[own][:, None] + np.arange(dim)]
            width = _width(x)
            x = x.astype(f"i{width}")
            size = max(1, ROW_BYTES // max(8, dim * width))
            for at in range(0, len(own), size):
                some = ids[own[at : at + size]]
                rows.append((dim, width, len(some), some.tobytes(), x[at : at + size].tobytes()))
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.record_batch(columns, names=["dim", "width", "n", "ids", "parts"])


def _unpacked(packs: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of ``(width, ids, parts)``."""
    widest = max(width for width, _, _ in packs)
    ids = np.frombuffer(b"".join(i for _, i, _ in packs), np.int64)
    if all(width == widest for width, _, _ in packs):
        flat = np.frombuffer(b"".join(x for _, _, x in packs), f"i{widest}")
    else:
        flat = np.concatenate([np.frombuffer(x, f"i{w}").astype(f"i{widest}") for w, _, x in packs])
    return ids, flat.reshape(len(ids), -1) if len(flat) else np.zeros((len(ids), 0), np.int8)


class Block:
    """Vectors with a sorted list of every component."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids, self.largest = x, ids, _largest(x)
        self._sorted_ids = np.sort(ids)
        self._ordered: np.ndarray | None = None
        self._known: dict = {}

    def _once(self, key, make) -> np.ndarray:
        if key not in self._known:
            self._known[key] = make()
        return self._known[key]

    def has(self, ids: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self._sorted_ids, ids)
        return self._sorted_ids[np.minimum(at, len(self.ids) - 1)] == ids

    def numbers(self, exact: type) -> np.ndarray:
        return self._once(exact, lambda: self.x.astype(exact))

    def _shown(self, exact: type, depth: int, rising, falling) -> np.ndarray:
        if self._ordered is None:
            self._ordered = np.sort(self.x, axis=0)
        x, ordered = self.x, self._ordered
        both = [rising(x, ordered, ordered[-depth]), falling(x, ordered, ordered[depth - 1])]
        return np.concatenate(both, axis=1).astype(exact).T

    def most(self, exact: type, depth: int) -> np.ndarray:
        """What the lists show of every vector at a depth, at most: from the
        high ends, then from the low ends."""
        return self._once(("most", exact, depth), lambda: self._shown(
            exact, depth, lambda x, _, high: np.maximum(x, high), lambda x, _, low: np.minimum(x, low)
        ))

    def least(self, exact: type, depth: int) -> np.ndarray:
        """The same, at least."""
        return self._once(("least", exact, depth), lambda: self._shown(
            exact, depth,
            lambda x, ordered, high: np.where(x >= high, x, ordered[0]),
            lambda x, ordered, low: np.where(x <= low, x, ordered[-1]),
        ))


class Best:
    """A pack of queries and the best ``k`` that each has met, in order."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, k: int):
        self.queries, self.ids, self.k = queries, ids, k
        self.largest = _largest(queries)
        self.scores = np.zeros((len(ids), k), np.int64)
        self.found = np.zeros((len(ids), k), np.int64)
        self.filled = np.zeros(len(ids), np.int64)
        self._first, self._met = 0, 0

    def _add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        some = np.unique(rows)
        held, at = np.nonzero(np.arange(self.k) < self.filled[some, None])
        rows = np.concatenate([some[held], rows])
        ids = np.concatenate([self.found[some[held], at], ids])
        scores = np.concatenate([self.scores[some[held], at], scores])
        order = np.lexsort((ids, ~scores, rows))
        rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = rank < self.k
        rows, rank, order = rows[kept], rank[kept], order[kept]
        self.scores[rows, rank], self.found[rows, rank] = scores[order], ids[order]
        self.filled[some] = np.bincount(rows, minlength=len(self.ids))[some]

    def read(self, block: Block) -> None:
        n, k = len(block.ids), self.k
        largest = self.largest * block.largest * max(1, block.x.shape[1])
        exact = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else object
        queries = self.queries.astype(exact)
        signed = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1)
        full = self.filled == k
        if exact is object:
            never = -(1 << 200)
            beaten = np.where(full, self.scores[:, -1].astype(object), never + 1)
        else:
            # No score is outside of these limits, which are exact as well.
            never, limit = -np.inf, int(largest) + 1
            beaten = np.where(full, self.scores[:, -1].clip(-limit, limit), -limit).astype(exact)
        with_own = block.has(self.ids)
        left = np.arange(len(self.ids))
        shares = DEPTHS[self._first if self._met % RETRY else 0 :]
        self._met += 1
        self._first = len(DEPTHS) - 1
        for share in shares:
            depth = max(1, min(n, ceil(share * n)))
            upper = queries[left] @ block.numbers(exact).T if depth == n else signed[left] @ block.most(exact, depth)
            own = np.flatnonzero(with_own[left])
            at, column = np.nonzero(self.ids[left[own]][:, None] == block.ids)
            upper[own[at], column] = never
            inside = upper >= beaten[left, None]
            many = np.flatnonzero((inside.sum(axis=1) > RESOLVED * n) & ((depth == n) | ~full[left]))
            if len(many) and n > k:
                if depth == n:
                    lower = upper[many]
                else:
                    lower = signed[left[many]] @ block.least(exact, depth)
                    lower[upper[many] == never] = never
                raised = np.maximum(np.partition(lower, n - k, axis=1)[:, n - k], beaten[left[many]])
                inside[many] = (upper[many] >= raised[:, None]) & (upper[many] > never)
            done = (inside.sum(axis=1) <= RESOLVED * n) | (depth == n)
            if done.any():
                self._first = min(self._first, DEPTHS.index(share))
                rows, columns = np.nonzero(inside[done])
                rows = np.flatnonzero(done)[rows]
                if depth == n:
                    scores = upper[rows, columns]
                else:
                    scores = (queries[left[rows]] * block.numbers(exact)[columns]).sum(axis=1)
                if len(rows):
                    self._add(left[rows], block.ids[columns], scores.astype(np.int64))
            left = left[~done]
            if not len(left):
                return

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``query_id, vec_id, score``."""
        rows, at = np.nonzero(np.arange(self.k) < self.filled[:, None])
        return self.ids[rows], self.found[rows, at], self.scores[rows, at]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``query, ids, scores`` of the best ``k`` of a block for each query."""
    best = Best(queries, query_ids, k)
    best.read(Block(x, ids))
    for query, filled in enumerate(best.filled):
        yield query, best.found[query, :filled], best.scores[query, :filled]


def _searched(k: int):
    """The best of every cell; its rows come together, queries first, then
    vectors by their length."""

    def found(held: dict[int, list[Best]]) -> Iterator[pa.RecordBatch]:
        for best in (best for packs in held.values() for best in packs):
            yield pa.record_batch([pa.array(c) for c in best.result()], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, count, held = None, [], 0, {}

        def read(side: int, dim: int) -> None:
            ids, x = _unpacked(waiting)
            waiting.clear()
            if side == 0:
                held.setdefault(dim, []).append(Best(x, ids, k))
                return
            block = Block(x, ids)
            for best in held[dim]:
                best.read(block)

        last = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cell", "side", "dim", "width", "n", "ids", "parts")]
            for its_cell, side, dim, width, n, ids, parts in zip(*columns, strict=True):
                if waiting and last != (its_cell, side, dim):
                    read(*last[1:])
                    count = 0
                if its_cell != cell:
                    yield from found(held)
                    cell = its_cell
                    held.clear()
                last = (its_cell, side, dim)
                if side == 1 and dim not in held:
                    continue
                waiting.append((width, ids, parts))
                count += n
                if count >= (BLOCK if side else PACK) or count * dim >= NUMBERS:
                    read(side, dim)
                    count = 0
        if waiting:
            read(*last[1:])
        yield from found(held)

    return run


def _size(packed: DataFrame, beside: int) -> tuple[int, int]:
    """Vectors, and their bytes with so many beside each."""
    n = F.col("n").cast("long")
    total = packed.select(F.sum(n), F.sum(n * (F.col("dim") * F.col("width") + beside))).first()
    return total[0] or 0, total[1] or 0


def grid(vectors: tuple[int, int], queries: tuple[int, int]) -> tuple[int, int]:
    """Rows and columns of the grid, from the numbers and bytes of vectors and
    queries: so that their copies, those of vectors one for every column and
    those of queries one for every row, are few together, and the queries of a
    cell fit into memory."""
    count = max(vectors[0], queries[0])
    cells = max(1, ceil(count / SHARE), min(FEW, ceil(count / (4 * BLOCK))))
    columns = min(cells, max(1, round(sqrt(cells * queries[1] / max(1, vectors[1])))))
    columns = max(columns, ceil(queries[1] / HELD))
    return ceil(cells / columns), columns


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best of ``vectors`` for
    every row of ``queries`` (both as ``quantized`` returns them), its own id
    left out; ties go to the smaller id.  Vectors meet queries of their own
    length only.  Without vectors there are no rows."""
    vectors = saved(vectors.mapInArrow(_packed, _PACKED), "top-k-vectors")
    queries = saved(queries.mapInArrow(_packed, _PACKED), "top-k-queries")
    # Beside a query: its id, what it found, and that once more as a result.
    rows, columns = grid(_size(vectors, 8), _size(queries, 8 + 40 * k))
    all_of = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    one_of = lambda count: F.pmod(F.xxhash64("ids"), F.lit(count)).cast("int")
    vectors = vectors.select("*", F.lit(1).alias("side"), one_of(rows).alias("row"), all_of(columns).alias("column"))
    queries = queries.select("*", F.lit(0).alias("side"), all_of(rows).alias("row"), one_of(columns).alias("column"))
    cell = (F.col("row") * columns + F.col("column")).alias("cell")
    both = queries.unionByName(vectors).select(cell, "side", *vectors.columns[:5])
    dealt = both.repartitionById(rows * columns, "cell").sortWithinPartitions("cell", "side", "dim")
    found = dealt.mapInArrow(_searched(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_of_table(embeddings: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """The ``k`` best of ``embeddings(vec_id, embedding)`` for each of its
    rows whose id is a multiple of ``every``.  Null vectors, vectors with a
    null or non-finite component and rows without an id take no part."""
    vectors = quantized(embeddings)
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)
