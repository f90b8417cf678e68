"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.tables import saved


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang every neighbour of a vertex on the smallest of them and itself:
    the larger neighbours, or the smaller ones and the vertex."""
    both = edges.select(F.col("src").alias("v"), F.col("dst").alias("u"))
    if larger:
        both = both.unionAll(edges.select(F.col("dst").alias("v"), F.col("src").alias("u")))
    else:
        both = edges.select(F.greatest("src", "dst").alias("v"), F.least("src", "dst").alias("u"))
    least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
    joined = both.join(least, "v")
    if larger:
        hung = joined.where("u > v").select(F.col("u").alias("src"), F.col("m").alias("dst"))
    else:
        hung = joined.select(F.col("u").alias("src"), F.col("m").alias("dst")).unionAll(
            least.select(F.col("v").alias("src"), F.col("m").alias("dst"))
        )
    return hung.where("src <> dst").distinct()


def components(links: DataFrame) -> DataFrame:
    """``vertex, component`` for every vertex of ``links(src, dst)`` (bigint);
    the component is its smallest vertex.

    Alternates large-star and small-star steps, which need about log n
    rounds whatever the shape, until the set of edges stays the same; each
    round is written, so no plan grows.  No links give no rows.
    """
    edges = saved(links.where("src <> dst").select("src", "dst").distinct(), "links")
    before = None
    while True:
        mark = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))
        ).first()
        if mark == before:
            break
        before = mark
        edges = saved(_star(_star(edges, True), False), "links")
    roots = edges.select(F.col("dst").alias("vertex"), F.col("dst").alias("component")).distinct()
    return edges.select(F.col("src").alias("vertex"), F.col("dst").alias("component")).unionAll(roots)
