"""Generators turn chunks into question-answer rows.

A generator is looked up by name.  The built-in one is made of column
expressions and needs no model; any other is a Python function over pandas
batches, which Spark calls in parallel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import fixed_values as fv
from docloom.functions.text import is_blank, strip

# Columns every generator gets.
INPUT_COLUMNS = ("chunk_id", "document", "document_outline", "domain")


class Generator(Protocol):
    schema: T.StructType

    def generate(self, chunks: DataFrame, concurrency: int | None, timeout: int) -> DataFrame: ...


class SentenceGenerator:
    """Deterministic stand-in for a model: the sentences of a chunk are its
    facts, and two questions are asked about each fact."""

    schema = T.StructType(
        [
            T.StructField("chunk_id", T.StringType()),
            T.StructField("fact_no", T.IntegerType()),
            T.StructField("fact", T.StringType()),
            T.StructField("qa_no", T.IntegerType()),
            T.StructField("question", T.StringType()),
            T.StructField("response", T.StringType()),
        ]
    )

    def generate(
        self,
        chunks: DataFrame,
        concurrency: int | None = None,
        timeout: int = fv.REQUEST_TIMEOUT_S,
    ) -> DataFrame:
        # Column expressions call nobody: there is nothing to limit or time out.
        sentences = F.transform(F.split("document", r"[.!?\n]+"), strip)
        facts = chunks.select(
            "chunk_id",
            "domain",
            F.posexplode(F.filter(sentences, lambda s: ~is_blank(s))).alias("fact_no", "fact"),
        )
        words = F.split("fact", " ")
        opening = F.array_join(F.slice(words, 1, 3), " ")
        pairs = F.array(
            F.struct(
                F.concat(F.lit("What does the "), F.col("domain"), F.lit(" documentation say about: "), opening, F.lit("?"))
                .alias("question"),
                F.col("fact").alias("response"),
            ),
            F.struct(
                F.concat(F.lit("How many words has the statement: "), F.col("fact"), F.lit("?")).alias("question"),
                F.size(words).cast("string").alias("response"),
            ),
        )
        asked = facts.select("chunk_id", "fact_no", "fact", F.posexplode(pairs).alias("qa_no", "pair"))
        return asked.select("chunk_id", "fact_no", "fact", "qa_no", "pair.question", "pair.response")


@dataclass(frozen=True)
class PandasGenerator:
    """A user's function ``(chunks: pandas.DataFrame, timeout) -> pandas.DataFrame``.

    It may return any number of rows per chunk, with exactly the columns of
    ``schema``.  A call gets ``rows_per_call`` chunks at most.  With
    ``on_error="fail"`` an exception ends the batch, which a
    later start runs again; with ``"column"`` the chunks of a failed call are
    tried one by one and a failing one becomes a row with only ``chunk_id``
    and ``error``.
    """

    function: Callable[[pd.DataFrame, int], pd.DataFrame]
    schema: T.StructType
    on_error: str = "fail"
    rows_per_call: int = fv.BATCH_SIZE

    def __post_init__(self):
        if self.on_error not in ("fail", "column"):
            raise ValueError(f"on_error must be 'fail' or 'column', got {self.on_error!r}")
        if self.on_error == "column" and not {"chunk_id", "error"} <= set(self.schema.names):
            raise ValueError("on_error='column' needs the columns chunk_id and error in the schema")

    def generate(
        self,
        chunks: DataFrame,
        concurrency: int | None = None,
        timeout: int = fv.REQUEST_TIMEOUT_S,
    ) -> DataFrame:
        """``concurrency`` tasks call the function at the same time at most: a
        partition is one caller.  Without it every task calls; give it (10
        suits one endpoint) where the function calls a shared service."""
        function, names, on_error, width = self.function, self.schema.names, self.on_error, self.rows_per_call

        def call(batch: pd.DataFrame) -> pd.DataFrame:
            rows = function(batch, timeout)
            got = list(rows.columns)
            if on_error == "column" and "error" not in got:
                rows = rows.assign(error=None)
                got.append("error")
            if sorted(got) != sorted(names):
                raise ValueError(f"generator returned columns {got}, declared are {names}")
            return rows[names]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for start in range(0, len(batch), width):
                    yield from attempt(batch.iloc[start : start + width].reset_index(drop=True))

        def attempt(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
            try:
                yield call(batch)
                return
            except Exception as error:  # noqa: BLE001 - reported in the row
                if on_error == "fail":
                    raise
                if len(batch) == 1:
                    row = dict.fromkeys(names)
                    row.update(chunk_id=batch["chunk_id"].iloc[0], error=f"{type(error).__name__}: {error}")
                    yield pd.DataFrame([row], columns=names)
                    return
            for i in range(len(batch)):
                yield from attempt(batch.iloc[i : i + 1].reset_index(drop=True))

        wanted = chunks.select(*INPUT_COLUMNS)
        spread = wanted if concurrency is None else wanted.repartition(concurrency)
        return spread.mapInPandas(run, self.schema)


_REGISTRY: dict[str, Generator] = {"sentences": SentenceGenerator()}


def register_generator(name: str, generator: Generator) -> None:
    _REGISTRY[name] = generator


def get_generator(name: str) -> Generator:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise ValueError(f"generator {name!r} not found; known generators: {sorted(_REGISTRY)}") from None


def generate_qa(
    chunks: DataFrame,
    generator: str = "sentences",
    concurrency: int | None = None,
    timeout: int = fv.REQUEST_TIMEOUT_S,
) -> DataFrame:
    """Apply a generator by name.  Write the result once and read it back: a
    second action on this frame would call the generator again."""
    return get_generator(generator).generate(chunks, concurrency, timeout)
