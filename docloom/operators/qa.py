"""Finalizing generated rows: trace removal, validation, chat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.messages import chat_messages, prompt_messages
from docloom.functions.text import null_if_missing, strip_reasoning


def _strip_any(value: Column, kind: T.DataType) -> Column:
    """Trace removal in every string below a column."""
    if isinstance(kind, T.StringType):
        return strip_reasoning(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _strip_any(item, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_strip_any(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def strip_traces(df: DataFrame, keep_cot: bool = False, nested: bool = False) -> DataFrame:
    """Remove reasoning traces from every string column; other types pass
    through.  ``nested`` also reaches into arrays and structs."""
    if keep_cot:
        return df

    def cleaned(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType) or nested:
            return _strip_any(column, field.dataType).alias(field.name)
        return column

    return df.select(*[cleaned(field) for field in df.schema.fields])


def require_columns(df: DataFrame, required: Sequence[str] = ("question", "response")) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}; available columns: {df.columns}")


def valid_qa(
    df: DataFrame,
    required: Sequence[str] = ("question", "response"),
    null_words: tuple[str, ...] = (),
) -> DataFrame:
    """Rows with a question and a response.  An empty value counts as
    missing; so do ``null_words`` if given."""
    require_columns(df, required)
    for name in required:
        if isinstance(df.schema[name].dataType, T.StringType):
            df = df.withColumn(name, null_if_missing(F.col(name), null_words))
    return df.dropna(subset=list(required))


def chat_rows(df: DataFrame, system_prompt: str | Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One ``messages`` array per valid row."""
    require_columns(df)
    return df.select(*keep, chat_messages(F.col("question"), F.col("response"), system_prompt).alias("messages"))


def prompt_rows(df: DataFrame, system_prompt: str | Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The same for questions that still need an answer."""
    require_columns(df, ["question"])
    return df.select(*keep, prompt_messages(F.col("question"), system_prompt).alias("messages"))


def qa_counts(df: DataFrame, required: Sequence[str] = ("question", "response")) -> DataFrame:
    """Rows, and rows that :func:`valid_qa` keeps, in one pass."""
    require_columns(df, required)
    complete = F.lit(True)
    for name in required:
        complete = complete & null_if_missing(F.col(name).cast("string")).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(complete).alias("n_valid"))
