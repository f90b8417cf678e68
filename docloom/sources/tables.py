"""Reading of question-answer tables and of adapter configs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import fixed_values as fv
from docloom.functions.messages import MESSAGES_TYPE, base_model
from docloom.functions.text import null_if_missing


def read_parquet(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """A Parquet table.  ``spread`` is for costly work per row on input that
    may be a few files with few row groups, which are not divisible: the rows
    are then dealt out to all cores.  A scan that already has several tasks
    per core, as any large one, is left alone."""
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if spread and table.rdd.getNumPartitions() < 4 * cores:
        return table.repartition(2 * cores)
    return table


def read_qa_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    multiline: bool = True,
    null_words: tuple[str, ...] = (),
) -> DataFrame:
    """A CSV table with a header; every column text unless a schema is given.

    An empty cell is null; so are ``null_words`` if given.  ``multiline``
    allows line feeds inside quotes, but then one file is one task: keep large
    tables in many files, or in Parquet as the steps here do.  A file whose
    header differs from the schema (or from the first file's header) in names
    or order is an error: cells are assigned by position.
    """
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
    reader = reader.option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    table = reader.csv(path)
    if not null_words:
        return table
    texts = {f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)}
    return table.select(
        *[null_if_missing(F.col(c), null_words).alias(c) if c in texts else F.col(c) for c in table.columns]
    )


def read_chat_jsonl(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Chat rows back as ``messages``; the file stays splittable."""
    lines = spark.read.text(path)
    parsed = F.from_json("value", f"struct<messages:{MESSAGES_TYPE}>")
    return lines.select(parsed["messages"].alias("messages"))


def resolve_base_models(
    spark: SparkSession, config_paths: Sequence[str], override: str | None = None
) -> DataFrame:
    """``path, base_model, adapter_base_model`` of adapter configs.

    A folder stands for the ``adapter_config.json`` in it.  A config without
    the field is an error.
    """
    files = [p if p.endswith(".json") else p.rstrip("/") + "/adapter_config.json" for p in config_paths]
    text = spark.read.text(files, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    own = base_model(F.col("value"))
    missing = F.raise_error(F.concat(F.lit(f"no {fv.BASE_MODEL_FIELD} in "), F.col("path"))).cast("string")
    checked = F.coalesce(own, missing)
    return text.select("path", checked.alias("adapter_base_model")).select(
        "path",
        F.coalesce(F.lit(override or None).cast("string"), F.col("adapter_base_model")).alias("base_model"),
        "adapter_base_model",
    )
