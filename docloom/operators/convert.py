"""Conversion of source documents to Markdown, one row per document."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.asciidoc import asciidoc_to_markdown, attribute_entries, clean_asciidoc
from docloom.functions.paths import extension, is_supported
from docloom.functions.text import normalise_newlines
from docloom.session import work_dir

# A converter gets the path and the bytes of one document and returns Markdown.
Converter = Callable[[str, bytes], str]

NATIVE_EXTENSION = ".adoc"


def decode_documents(files: DataFrame) -> DataFrame:
    """``content`` as UTF-8 text with line feeds only.  Bytes that are not
    UTF-8 give a null text and an ``error`` instead of a failed job."""
    raw = F.col("content").cast("string")
    valid = F.is_valid_utf8(raw)
    kept = [name for name in files.columns if name != "content"]
    return files.select(
        *kept,
        F.when(valid, normalise_newlines(raw)).alias("text"),
        F.when(~valid, F.lit("not valid UTF-8")).alias("error"),
    )


def with_status(docs: DataFrame) -> DataFrame:
    """Extension and whether it is one of the supported ones."""
    ext = extension(F.col("path"))
    return docs.withColumns(
        {"ext": ext, "status": F.when(is_supported(ext), "supported").otherwise("unsupported")}
    )


_REFERENCE = r"\{([^{}\n]+)\}"


def _references(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(1)))


def shared_attributes(docs: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``attributes`` of ``docs(key, text)``: defaults, then rows of a shared
    ``name, value`` table by name, then the document's own definitions.

    The table may be of any size: a document gets the rows it refers to, and
    those that these refer to.  References are looked up by equality joins and
    written level by level; no row of the table goes through the driver.  A
    reference that only comes about by substitution inside braces
    (``{a{b}}``) finds no shared row that nothing else refers to.  Of rows with the same name the
    greatest value counts; rows without a name or value are left out.  ``key``
    should be unique; documents that repeat it get each other's rows as well.
    """
    given = table.where("name IS NOT NULL AND value IS NOT NULL")
    if not given.where("contains(name, chr(10)) OR contains(value, chr(10))").isEmpty():
        raise ValueError("a shared attribute must be one line")
    spark, base = docs.sparkSession, work_dir(docs.sparkSession, "attributes")

    def saved(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    rows = saved(given.groupBy("name").agg(F.max("value").alias("value")), "rows")
    uses = rows.where(F.contains("value", F.lit("{"))).select("name", F.explode(_references(F.col("value"))).alias("used"))
    uses = saved(uses.join(rows.select(F.col("name").alias("used")), "used", "left_semi"), "uses")
    asked = docs.where(F.contains("text", F.lit("{"))).select(
        F.col(key).alias("_key"), F.explode(_references(F.col("text"))).alias("name")
    )
    new = saved(asked.distinct().join(rows.select("name"), "name", "left_semi"), "hits/level=0")
    level = 0
    while not new.isEmpty():
        level += 1
        known = spark.read.schema(new.schema).option("basePath", f"{base}/hits").parquet(f"{base}/hits").drop("level")
        reached = new.join(uses, "name").select("_key", F.col("used").alias("name")).distinct().alias("r")
        seen = F.col("r._key").eqNullSafe(F.col("k._key")) & (F.col("r.name") == F.col("k.name"))
        new = saved(reached.join(known.alias("k"), seen, "left_anti").select("name", "_key"), f"hits/level={level}")
    hits = spark.read.schema(new.schema).option("basePath", f"{base}/hits").parquet(f"{base}/hits").drop("level")
    entry = F.struct("name", "value")
    found = hits.join(rows, "name").groupBy("_key").agg(F.sort_array(F.collect_list(entry)).alias("_shared"))
    shared = F.coalesce("_shared", F.array().cast("array<struct<name:string,value:string>>"))
    joined = docs.join(found, docs[key].eqNullSafe(found["_key"]), "left")
    return joined.select(
        *[docs[f"`{name}`"] for name in docs.columns if name != "attributes"],
        attribute_entries(docs["text"], shared=shared).alias("attributes"),
    )


def asciidoc_markdown(text: Column, entries: Column | None = None) -> Column:
    return asciidoc_to_markdown(clean_asciidoc(text, entries))


def _hook(converters: Mapping[str, Converter]):
    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results, errors = [], []
            for ext, path, content in zip(batch["ext"], batch["path"], batch["content"], strict=True):
                try:
                    results.append(converters[ext](path, bytes(content)))
                    errors.append(None)
                except Exception as error:  # noqa: BLE001 - one bad document must not end the job
                    results.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            yield pd.DataFrame({"path": batch["path"], "md": results, "error": errors})

    return convert


def convert_native(files: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """``path, content`` -> ``path, md, error`` by column expressions alone.
    What is not AsciiDoc, or not UTF-8, keeps its row with an ``error``.

    ``shared(name, value)`` are attributes of all documents, see
    :func:`shared_attributes`; the decoded texts are then written once, since
    they are read for their references and for the conversion.
    """
    ext = extension(F.col("path"))
    decoded = decode_documents(files.select("path", "content", ext.alias("ext")))
    native = F.col("ext") == NATIVE_EXTENSION
    entries = None
    if shared is not None:
        spark, place = files.sparkSession, work_dir(files.sparkSession, "texts")
        decoded.write.parquet(place)
        decoded = shared_attributes(spark.read.schema(decoded.schema).parquet(place), shared, "path")
        entries = F.col("attributes")
    return decoded.select(
        "path",
        F.when(native, asciidoc_markdown(F.col("text"), entries)).alias("md"),
        F.when(~native, F.concat(F.lit("Unsupported extension: "), F.col("ext"))).otherwise(F.col("error")).alias("error"),
    )


def convert_by_hook(files: DataFrame, converters: Mapping[str, Converter]) -> DataFrame:
    """The same by Python functions, one per lower-case extension.  One that
    raises gives its document an ``error``."""
    with_ext = files.select("path", "content", extension(F.col("path")).alias("ext"))
    return with_ext.mapInPandas(_hook(dict(converters)), "path string, md string, error string")


def convert_documents(files: DataFrame, converters: Mapping[str, Converter] | None = None) -> DataFrame:
    """Dispatch by extension over one table of files: to ``converters``,
    which may also replace the native one, else to the native one.

    Each of the two reads the table; for a document tree use
    :func:`docloom.sources.documents.convert_tree`, which reads a file once.
    """
    if not converters:
        return convert_native(files)
    hooked = extension(F.col("path")).isin(*converters)
    return convert_native(files.where(~hooked)).unionByName(convert_by_hook(files.where(hooked), converters))


def split_converted(converted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents that came through, and those that did not."""
    good = converted.where(F.col("error").isNull()).select("path", "md")
    return good, converted.where(F.col("error").isNotNull()).select("path", "error")


def conversion_report(converted: DataFrame) -> DataFrame:
    """Documents per extension and outcome."""
    status = F.when(F.col("error").isNull(), "converted").otherwise("failed")
    return converted.groupBy(extension(F.col("path")).alias("ext"), status.alias("status")).agg(
        F.count(F.lit(1)).alias("n_docs")
    )
