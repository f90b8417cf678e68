"""Writers.  Each is one pass; row counts come from the write itself."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docloom import fixed_values as fv
from docloom.operators.qa import chat_rows, require_columns, strip_traces, valid_qa
from docloom.session import path_exists, qualified, replace_path
from docloom.sources.stores import write_contents


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    count = Observation()
    return df.observe(count, F.count(F.lit(1)).alias("n")), count


def write_dataset(qa: DataFrame, path: str, keep_cot: bool = False, mode: str = "overwrite") -> int:
    """The final dataset as Parquet; returns the number of rows."""
    rows, count = _observed(strip_traces(qa, keep_cot))
    rows.write.mode(mode).parquet(path)
    return count.get["n"]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """CSV with a header, quotes doubled, no index."""
    rows, count = _observed(df)
    writer = rows.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "")
    # Spark trims cells by default; white space is part of the text here.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return count.get["n"]


def write_chat_jsonl(
    qa: DataFrame,
    path: str,
    system_prompt: str | Column | None = None,
    mode: str = "overwrite",
    null_words: tuple[str, ...] = (),
) -> int:
    """Chat rows as JSON Lines; returns their number and fails when there is
    none, in which case an earlier output stays.  Non-ASCII characters stay as
    they are."""
    require_columns(qa)
    rows, count = _observed(chat_rows(valid_qa(qa, null_words=null_words), system_prompt))
    lines = rows.select(F.to_json(F.struct("messages")))
    spark = qa.sparkSession
    aside = mode == "overwrite" and path_exists(spark, path)
    target = _pending(path) if aside else path
    lines.write.mode(mode).text(target)
    written = count.get["n"]
    if written == 0:
        raise ValueError("no valid training examples: every question or response is missing")
    if aside:
        replace_path(spark, target, path)
    return written


def _pending(path: str) -> str:
    """A new folder beside ``path`` that no reader of ``path`` looks into."""
    return f"{path.rstrip('/')}-pending-{uuid.uuid4().hex}"


def write_converted(converted: DataFrame, path: str, mode: str = "overwrite") -> dict[str, int]:
    """``path, md, error`` as one table partitioned by ``status``.

    One pass, so a converter runs once per document; :func:`read_converted`
    prunes to the good or the failed ones.  Returns the numbers found,
    converted and failed; fails when no document was converted, and then
    leaves ``path`` as it was.
    """
    spark = converted.sparkSession
    target = _pending(path) if mode == "overwrite" else path
    count = Observation()
    failed = F.col("error").isNotNull()
    converted.withColumn("status", F.when(failed, "failed").otherwise("converted")).observe(
        count,
        F.count(F.lit(1)).alias("found"),
        F.count_if(~failed).alias("converted"),
        F.count_if(failed).alias("failed"),
    ).write.mode(mode).partitionBy("status").parquet(target)
    totals = {name: count.get[name] for name in ("found", "converted", "failed")}
    if totals["converted"] == 0:
        raise ValueError(f"no document was converted ({totals['found']} found)")
    if target != path:
        replace_path(spark, target, path)
    return totals


def read_converted(spark: SparkSession, path: str, status: str = "converted") -> DataFrame:
    schema = "path string, md string, error string, status string"
    return spark.read.schema(schema).parquet(path).where(F.col("status") == status).drop("status")


def write_merged_corpus(
    docs: DataFrame,
    path: str,
    order: tuple[str, ...] = ("path",),
    text: str = "md",
    separator: str = fv.MERGE_SEPARATOR,
    mode: str = "overwrite",
) -> None:
    """The merged corpus as text files.

    The files in name order, one after the other, are the corpus: documents
    in order with the separator between them, and the separator's last
    character (a line feed by default) at the very end.  A range sort spreads
    the corpus over tasks; no task holds more than its share.  ``docs`` is
    scanned for its last key and for the sort's ranges too, so let it be a
    written table.
    """
    if not separator:
        raise ValueError("the separator must not be empty")
    last = docs.agg(F.max(F.struct(*order))).scalar()
    piece = F.when(F.struct(*order) == last, F.col(text)).otherwise(F.concat(text, F.lit(separator[:-1])))
    pieces = docs.orderBy(*order).select(piece.alias("value"))
    pieces.write.mode(mode).option("lineSep", separator[-1]).text(path)


def write_documents(docs: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """One row per document instead of one file per document."""
    writer = docs.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_files(docs: DataFrame, path: str) -> int:
    """One file per row of ``docs(path, content)``, at its ``path`` below the
    folder ``path``; returns their number.  Paths must be distinct; a text is
    written as ``encode(text, 'UTF-8')``."""
    spark = docs.sparkSession
    written = docs.select("path", F.col("content").cast("binary").alias("content"))
    written = written.mapInArrow(write_contents(qualified(spark, path)), "path string, length bigint")
    return written.count()
