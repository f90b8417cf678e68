"""From a document tree to chat rows, in tables that later steps read."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import fixed_values as fv
from docloom.operators.chunks import chunk_documents, dedup_chunks, generator_input
from docloom.operators.convert import Converter
from docloom.operators.generators import get_generator
from docloom.session import path_exists
from docloom.sources.documents import NATIVE, convert_tree, list_files
from docloom.sources.sinks import read_converted, write_chat_jsonl, write_converted, write_dataset
from docloom.streaming.generation import open_run, process_staged, read_generated, stage_chunks

#: Chunks in a staged file and files in a micro-batch.  A generator's calls
#: are cut smaller by the generator itself.
STAGED_ROWS = 20_000
STAGED_FILES = 32


@dataclass(frozen=True)
class Settings:
    """What shapes the result; the defaults are the usual ones."""

    generator: str = "sentences"
    outline: str = fv.OUTLINE
    domain: str = fv.DOMAIN
    max_chars: int = fv.MAX_CHUNK_CHARS
    batch_size: int = STAGED_ROWS
    files_per_batch: int = STAGED_FILES
    concurrency: int | None = None
    timeout: int = fv.REQUEST_TIMEOUT_S
    keep_cot: bool = False
    system_prompt: str | None = None


def prepare_chunks(documents: DataFrame, settings: Settings, order: str = "path") -> DataFrame:
    """Markdown documents -> deduplicated, named generator input."""
    chunks = chunk_documents(documents.select(order, "md"), max_chars=settings.max_chars)
    return generator_input(
        dedup_chunks(chunks, (order, "pos")),
        settings.outline,
        settings.domain,
        settings.max_chars,
        settings.generator,
    )


def convert_inputs(
    spark: SparkSession,
    inputs: Sequence[str],
    target: str,
    converters: Mapping[str, Converter] | None = None,
    resume: bool = False,
    shared: DataFrame | None = None,
) -> dict[str, int]:
    """Convert a tree to the table ``documents`` below ``target``.

    With ``resume`` a document is taken over if the table has it and its file
    has the length, time and converter it had; new and changed ones, and those
    a converter hook failed on, are converted, and those whose file is gone go.  Nothing is written if
    all are taken over.
    """
    documents, manifest = f"{target}/documents", f"{target}/files"
    now = list_files(spark, inputs, converters, shared=shared)
    if not (resume and path_exists(spark, f"{documents}/_SUCCESS") and path_exists(spark, f"{manifest}/_SUCCESS")):
        counts = write_converted(convert_tree(spark, inputs, converters, shared=shared), documents)
        now.write.mode("overwrite").parquet(manifest)
        return counts
    known = spark.read.schema(now.schema).parquet(manifest)
    # What the native conversion rejects it rejects again; a hook may not.
    rejected = read_converted(spark, documents, "failed").join(
        known.where(F.startswith("converter", F.lit(NATIVE))).select("path"), "path", "left_semi"
    )
    before = read_converted(spark, documents).unionByName(rejected)
    same = before.select("path").join(known.join(now, now.columns, "left_semi"), "path", "left_semi")
    listed, taken, had = now.count(), same.count(), before.count()
    if listed == taken == had:
        return {}
    kept = before.join(same, "path", "left_semi")
    converted = convert_tree(spark, inputs, converters, done=same, shared=shared)
    counts = write_converted(converted.unionByName(kept), documents)
    now.write.mode("overwrite").parquet(manifest)
    return counts


def run_name(settings: Settings, chunks: DataFrame) -> str:
    """Names what a run's rows depend on: settings, generator and its columns.

    Rows without a ``chunk_id`` cannot be told apart later, so the run of such
    a generator is bound to its set of chunks as well.
    """
    schema = get_generator(settings.generator).schema
    parts = [settings.generator, schema.json(), settings.outline, settings.domain, str(settings.max_chars)]
    if "chunk_id" not in schema.names:
        mark = chunks.agg(F.count(F.lit(1)), F.sum(F.xxhash64("chunk_id").cast("decimal(38,0)"))).first()
        parts.append(repr(tuple(mark)))
    return hashlib.sha256("\x1f".join(parts).encode()).hexdigest()[:16]


def build_training_set(
    spark: SparkSession,
    inputs: Sequence[str],
    target: str,
    settings: Settings | None = None,
    converters: Mapping[str, Converter] | None = None,
    resume: bool = False,
    shared: DataFrame | None = None,
) -> dict[str, int]:
    """Convert, chunk, deduplicate, generate, finalize and export.

    Below ``target``: ``documents`` and ``files``, ``generation/<settings>/run=<n>``,
    ``dataset`` and ``train`` (JSON Lines).  With ``resume`` unchanged
    documents and finished chunks are used again: the latest run with the same
    settings and generator goes on.  The result is that of a fresh call in any
    case: it has the rows of the present chunks only.  ``shared(name, value)``
    are attributes of all AsciiDoc documents; if they change, these are
    converted again.
    """
    settings = settings or Settings()
    counts = convert_inputs(spark, inputs, target, converters, resume, shared)
    chunks = prepare_chunks(read_converted(spark, f"{target}/documents"), settings)
    run = open_run(spark, f"{target}/generation/{run_name(settings, chunks)}", resume)
    stage_chunks(run, chunks, settings.batch_size)
    process_staged(
        run, spark, settings.generator, settings.concurrency, settings.timeout, settings.files_per_batch
    )
    generated = read_generated(run, spark, settings.generator, keep_cot=True)
    if resume and "chunk_id" in generated.columns:
        generated = generated.join(chunks.select("chunk_id"), "chunk_id", "left_semi")
    counts["rows"] = write_dataset(generated, f"{target}/dataset", settings.keep_cot)
    counts["examples"] = write_chat_jsonl(
        spark.read.parquet(f"{target}/dataset"), f"{target}/train", settings.system_prompt
    )
    return counts
