"""From documents to the deduplicated input of a generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as fv
from docloom.functions.chunking import chunk_array
from docloom.functions.messages import chunk_id
from docloom.functions.text import clean_technical
from docloom.operators.ordering import first_per_key


def chunk_documents(
    docs: DataFrame,
    text: str = "md",
    max_chars: int = fv.MAX_CHUNK_CHARS,
    strict: bool = False,
) -> DataFrame:
    """Clean and cut every document; one row per chunk with its ``pos``.

    A narrow stage: nothing is shuffled, and the document text does not
    travel past the explode.
    """
    kept = [name for name in docs.columns if name != text]
    cleaned = docs.select(*kept, clean_technical(F.col(text), strict).alias("_clean"))
    chunks = cleaned.select(*kept, chunk_array(F.col("_clean"), max_chars).alias("_chunks"))
    # For a plain explode the optimizer adds a filter on the array's size and
    # pushes it down, which computes the whole array once more.
    exploded = chunks.select(*kept, F.posexplode_outer("_chunks").alias("pos", "chunk"))
    return exploded.where(F.col("pos").isNotNull())


def chunks_per_document(docs: DataFrame, text: str = "md", max_chars: int = fv.MAX_CHUNK_CHARS) -> DataFrame:
    """Number of chunks of each document, without exploding them."""
    kept = [name for name in docs.columns if name != text]
    cleaned = docs.select(*kept, clean_technical(F.col(text)).alias("_clean"))
    return cleaned.select(*kept, F.size(chunk_array(F.col("_clean"), max_chars)).alias("n_chunks"))


def dedup_chunks(chunks: DataFrame, order: tuple[str, ...] = ("doc_id", "pos")) -> DataFrame:
    """Keep each chunk once, where it appears first in document order."""
    return first_per_key(chunks, ["chunk"], [F.col(name) for name in order])


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """Chunks, different chunks, and how many a dedup removes.

    The chunks are first grouped by digest, so 32 bytes per different chunk
    and task are shuffled instead of the text.
    """
    by_digest = chunks.groupBy(F.unhex(F.sha2("chunk", 256)).alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
    return by_digest.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_chunks"),
        F.count(F.lit(1)).alias("n_distinct"),
    ).withColumn("n_duplicates", F.col("n_chunks") - F.col("n_distinct"))


def generator_input(
    chunks: DataFrame,
    outline: str | Column = fv.OUTLINE,
    domain: str | Column = fv.DOMAIN,
    max_chars: int = fv.MAX_CHUNK_CHARS,
    generator: str = "",
) -> DataFrame:
    """Attach outline and domain and name every chunk.

    ``outline`` and ``domain`` may be columns, e.g. of a metadata table
    joined on the source.
    """
    outline = outline if isinstance(outline, Column) else F.lit(outline)
    domain = domain if isinstance(domain, Column) else F.lit(domain)
    kept = [name for name in chunks.columns if name != "chunk"]
    return chunks.select(
        chunk_id(F.col("chunk"), outline, domain, max_chars, generator).alias("chunk_id"),
        *kept,
        F.col("chunk").alias("document"),
        outline.alias("document_outline"),
        domain.alias("domain"),
    )


def with_source_metadata(chunks: DataFrame, metadata: DataFrame, on: str = "source") -> DataFrame:
    """Look up ``document_outline`` and ``domain`` per source; defaults where
    the table has no row.

    No broadcast hint: Spark broadcasts the table only below its size limit.
    Beyond it, the join shuffles, and adaptive skew handling splits a source
    that holds much of the data.
    """
    columns = [on, "document_outline", "domain"]
    joined = chunks.join(metadata.select(*columns), on, "left")
    return joined.withColumns(
        {
            "document_outline": F.coalesce("document_outline", F.lit(fv.OUTLINE)),
            "domain": F.coalesce("domain", F.lit(fv.DOMAIN)),
        }
    )
