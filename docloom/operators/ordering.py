"""Order without a list: first or last row per key, and dense positions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from docloom.session import work_dir


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first whole row of every key.

    Spark cuts each key down to one row per task *before* the shuffle (a
    window group limit), so a key that holds a third of all rows sends one
    row per task.  The hash in front makes the sort compare eight bytes
    instead of a long text; the keys behind it keep the result exact.
    """
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def block_of(key: str, width: int) -> Column:
    """Number of the block of ``width`` key values a row falls into."""
    return F.expr(f"`{key}` div {int(width)}")


def running_totals(df: DataFrame, order: Sequence[Column], amounts: Mapping[str, Column]) -> DataFrame:
    """Adds, for every name, the total of its amount over all earlier rows.

    ``order`` are expressions over the columns of ``df``, of any type; equal
    rows may take each other's place.  No window spans the table: rows are dealt
    out by ranges of the order and written, the totals of the ranges (one row
    each) are added up, and rows are summed inside their range.
    """
    numbered = df.select("*", *[amount.cast("long").alias(f"_{name}") for name, amount in amounts.items()])
    path = work_dir(df.sparkSession, "ranges")
    numbered.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    totals = ranged.groupBy("_range").agg(*[F.sum(f"_{name}").alias(f"_all_{name}") for name in amounts])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range", *[F.coalesce(F.sum(f"_all_{name}").over(earlier), F.lit(0)).alias(f"_all_{name}") for name in amounts]
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(offsets, "_range").select(
        *df.columns,
        *[
            (F.col(f"_all_{name}") + F.coalesce(F.sum(f"_{name}").over(inside), F.lit(0))).alias(name)
            for name in amounts
        ],
    )


def dense_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """Positions 0, 1, 2, ... in the order of ``order``, columns of any type
    that sorts; no window spans the table, however its keys are spread."""
    return running_totals(df, [F.col(column) for column in order], {name: F.lit(1)})
