"""Top-k search over a grid of cells: what a task holds, returns and is sent."""

import numpy as np
import pyarrow as pa
import pytest

from docloom.llm import topk
from docloom.llm.topk import HELD, grid, nearest_of_table


def best(queries, query_ids, x, ids, k):
    found = []
    for query, own in zip(queries.tolist(), query_ids.tolist(), strict=True):
        scores = [(-sum(a * b for a, b in zip(query, v, strict=True)), i) for v, i in zip(x.tolist(), ids.tolist(), strict=True) if i != own]
        found += [(own, i, -score) for score, i in sorted(scores)[:k]]
    return sorted(found)


def batches(cells, size, r):
    """Batches of rows as a task reads them: by cell, queries first, by length."""
    rows = []
    for cell, sides in enumerate(cells):
        for side, parts in enumerate(sides):
            for x, ids in sorted(parts, key=lambda part: part[0].shape[1]):
                for at in range(0, len(ids), size):
                    some, width = x[at : at + size], topk._width(x[at : at + size])
                    rows.append((cell, side, x.shape[1], width, len(some), ids[at : at + size].tobytes(), some.astype(f"i{width}").tobytes()))
    names, kinds = ["cell", "side", "dim", "width", "n", "ids", "parts"], [pa.int32()] * 5 + [pa.binary()] * 2
    while rows:
        some = [rows.pop(0) for _ in range(min(len(rows), int(r.integers(1, 20))))]
        yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*some, strict=True), kinds, strict=True)], names=names)


@pytest.mark.parametrize("block", [1, 7, 64, 4096])
@pytest.mark.parametrize("spread", [0, 1, 3, 1000, 10**6, 2**28])
def test_cells_are_exact(monkeypatch, block, spread):
    """Over many blocks, with ties, repeated ids, lengths that do not meet and
    numbers beyond exact floats, each query has ``k`` rows and no more."""
    r = np.random.default_rng(spread + block)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "PACK", 8)
    cells, expected = [], []
    for _ in range(3):
        sides = [], []
        for dim in (0, 2, 6):
            x, ids = r.integers(-spread, spread + 1, (150, dim)), r.integers(0, 120, 150)
            sides[0].append((x[:20], ids[:20]))
            sides[1].append((x, ids))
            expected += best(x[:20], ids[:20], x, ids, 5)
        sides[1].append((r.integers(-spread, spread + 1, (30, 3)), np.arange(30)))
        cells.append(sides)
    found = [tuple(row.values()) for batch in topk._searched(5)(batches(cells, 4, r)) for row in batch.to_pylist()]
    assert sorted(found) == sorted(expected) and len(found) == 3 * 3 * 20 * 5


def test_search_broadcasts_nothing(spark):
    """Whatever Spark takes for small; before, the blocks or the queries were
    sent through the driver to every executor."""
    r = np.random.default_rng(5)
    x = r.normal(0, 0.3, (3000, 8)).astype(np.float32)
    ids = r.permutation(3000).astype(np.int64)
    table = spark.createDataFrame([(int(i), v) for i, v in zip(ids, x.tolist(), strict=True)], "vec_id long, embedding array<float>")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        frame = nearest_of_table(table)
        got = frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Broadcast" not in plan and "Join" not in plan
    parts = np.floor(x.astype(np.float64) * 256).astype(np.int64)
    chosen = ids % 50 == 0
    expected = best(parts[chosen], ids[chosen], parts, ids, 5)
    assert sorted((row["query_id"], row["vec_id"], row["score"]) for row in got) == expected
    assert sorted((row["query_id"], row["rank"]) for row in got) == [(i, rank) for i in sorted(ids[chosen].tolist()) for rank in range(1, 6)]


@pytest.mark.parametrize("count", [0, 1, 10_000, 10**6, 23 * 10**6, 115 * 10**6])
@pytest.mark.parametrize("every", [1, 50, 10**5])
def test_grid_holds_a_bounded_share_of_queries(count, every):
    queries = -(-count // every)
    rows, columns = grid((count, 136 * count), (queries, 344 * queries))
    assert rows >= 1 and columns >= 1
    assert 344 * queries / columns <= HELD
    assert rows * columns >= count / topk.SHARE
    if every == 50 and count > 1:
        cells = rows * columns
        copies = (columns * 136 * count + rows * 344 * queries) / max(1, 136 * count)
        assert copies <= 1.2 + 2.5 * (0.05 * cells) ** 0.5
