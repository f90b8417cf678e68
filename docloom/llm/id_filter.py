"""A set of ids as a bitmap of fixed size, to leave texts out of shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.tables import saved

#: Bits of a filter: 8 MB at any size, in rows of 4 KB.
FILTER_BITS = 26


def _bit(doc_id: Column) -> Column:
    # Buckets of Spark's bitmaps begin at 1, 32769, ...
    return F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(1 << FILTER_BITS)) + 1


def marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs(doc_id, ...)`` with ``__hit``: whether a hash of the id is one of
    those in the one column of ``ids``, which holds for all of them and few others.

    The bitmap, one bit per hash, has ``2 ** FILTER_BITS`` bits at most however
    many ids there are, which is what makes it fit to be broadcast.  It lets a
    pass over the texts leave out most of what is not asked for before anything
    is shuffled; the joins behind it decide.
    """
    bit = _bit(F.col(ids.columns[0]))
    maps = ids.groupBy(F.bitmap_bucket_number(bit).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("__bits")
    )
    bit = _bit(F.col("doc_id"))
    placed = docs.select("*", F.bitmap_bucket_number(bit).alias("__bucket"), F.bitmap_bit_position(bit).alias("__at"))
    found = placed.join(F.broadcast(saved(maps, "id-filter")), "__bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__at div 8 as int) + 1, 1)")), 16, 10).cast("long")
    hit = F.coalesce(F.getbit(byte, (F.col("__at") % 8).cast("int")) == 1, F.lit(False))
    return found.select(*[F.col(f"`{name}`") for name in docs.columns], hit.alias("__hit"))


def without_ids(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs(doc_id, ...)`` whose id is not in the one column of
    ``gone``, which holds each id once.

    Rows that the filter of those ids does not hit stay where they are; only
    the others, few more than go, meet the ids in a join.  Rows without an id
    stay.
    """
    found = marked(docs, gone)
    named = gone.select(F.col(gone.columns[0]).cast("long").alias("__gone"))
    doubtful = found.where("__hit").join(named, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    return found.where("NOT __hit").unionByName(doubtful).drop("__hit")
