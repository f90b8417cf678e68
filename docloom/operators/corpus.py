"""Whole-corpus operators: merge, one output per name, fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as fv
from docloom.functions.messages import fingerprint
from docloom.functions.paths import base_name
from docloom.operators.ordering import block_of, first_per_key


def merge_documents(
    docs: DataFrame,
    group: str,
    order: str,
    text: str = "md",
    separator: str = fv.MERGE_SEPARATOR,
    docs_per_part: int = 256,
) -> DataFrame:
    """Join the documents of a group, in order, with a separator.

    A group may hold most of the data, so it comes out in numbered parts:
    ``md`` of the parts in order of ``part``, joined by the separator, is the
    merged corpus.  ``order`` is a unique integer; a part covers
    ``docs_per_part`` of its values, which bounds what one task collects.
    """
    part = block_of(order, docs_per_part).alias("part")
    collected = docs.groupBy(group, part).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sort_array(F.collect_list(F.struct(F.col(order), F.col(text).alias("_text")))).alias("_docs"),
    )
    merged = F.array_join(F.transform("_docs", lambda doc: doc["_text"]), separator)
    return collected.select(group, "part", "n_docs", merged.alias("md"))


def latest_by_base_name(docs: DataFrame, path: str = "path", order: tuple[str, ...] = ("path",)) -> DataFrame:
    """One document per output name; the later one overwrites."""
    named = docs.withColumn("base_name", base_name(F.col(path)))
    return first_per_key(named, ["base_name"], [F.col(name).desc() for name in order])


def document_fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    return docs.select(key, fingerprint(F.col(text)).alias("fingerprint"))


def corpus_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """One digest for a set of documents, whatever their order.

    The SHA-256 of every document is cut into eight 32-bit numbers that are
    summed up, and the sums are digested together with the number of
    documents.  It is an ordinary aggregation: no list of digests is built
    and only one row per task is shuffled.
    """
    digest = docs.select(F.sha2(F.col(text), 256).alias("_digest"))
    words = [
        F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)") for i in range(8)
    ]
    sums = digest.agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.coalesce(F.sum(word), F.lit(0)).cast("string").alias(f"_w{i}") for i, word in enumerate(words)],
    )
    combined = F.concat_ws(":", F.col("n_docs").cast("string"), *[f"_w{i}" for i in range(8)])
    return sums.select("n_docs", fingerprint(combined).alias("fingerprint"))
