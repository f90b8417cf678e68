"""Resumable generation: chunks in micro-batches through a generator.

A run is a folder::

    staged/               the chunks to do, ``batch_size`` rows per file
    qa/batch_id=<n>/      rows the generator made in micro-batch n
    ledger/batch_id=<n>/  chunks done in micro-batch n
    checkpoint/           the stream's own record of finished files

The chunk files are the source of a stream that ends when nothing is left.
A micro-batch overwrites only its own two folders, so running it again after
a crash leaves the same rows as running it once.  Calls of a generator are
made at least once, its rows are kept exactly once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import fixed_values as fv
from docloom.operators.generators import INPUT_COLUMNS, get_generator
from docloom.operators.ordering import dense_index
from docloom.operators.qa import strip_traces
from docloom.session import child_names, path_exists

_RUN_PREFIX = "run="
#: A run's tables hold every fact several times, far apart: zstd finds more of it
#: than the default codec and writes a third less.
_CODEC = "zstd"


@dataclass(frozen=True)
class GenerationRun:
    root: str

    @property
    def staged(self) -> str:
        return f"{self.root}/staged"

    @property
    def qa(self) -> str:
        return f"{self.root}/qa"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def open_run(spark: SparkSession, base: str, resume: bool = False) -> GenerationRun:
    """The latest run below ``base``, or a new one.  A fresh run never
    deletes an earlier one."""
    numbers = [int(name.removeprefix(_RUN_PREFIX)) for name in child_names(spark, base) if name.startswith(_RUN_PREFIX)]
    latest = max(numbers, default=0)
    number = max(latest, 1) if resume else latest + 1
    return GenerationRun(f"{base.rstrip('/')}/{_RUN_PREFIX}{number:05d}")


# --- batch form ------------------------------------------------------------


def pending_chunks(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """Chunks without an entry in ``done``.  Only the ids of the finished
    chunks are read, and ids are unique, so no key is hot."""
    return chunks.join(done.select("chunk_id"), "chunk_id", "left_anti")


def batch_index(chunks: DataFrame, order: tuple[str, ...] = ("doc_id", "pos"), batch_size: int = fv.BATCH_SIZE) -> DataFrame:
    """Dense position and batch number of every chunk, in document order."""
    indexed = dense_index(chunks, order)
    return indexed.withColumn("batch_no", F.expr(f"idx div {int(batch_size)}"))


def batch_plan(chunks: DataFrame, order: tuple[str, ...] = ("doc_id", "pos"), batch_size: int = fv.BATCH_SIZE) -> DataFrame:
    """First and last chunk of every batch, counted from 1."""
    indexed = batch_index(chunks.select(*order), order, batch_size)
    return indexed.groupBy("batch_no").agg(
        (F.min("idx") + 1).alias("first_chunk"),
        (F.max("idx") + 1).alias("last_chunk"),
        F.count(F.lit(1)).alias("n_chunks"),
        F.min(order[0]).alias(f"first_{order[0]}"),
        F.max(order[0]).alias(f"last_{order[0]}"),
    )


# --- stream form -----------------------------------------------------------


def stage_chunks(run: GenerationRun, chunks: DataFrame, batch_size: int = fv.BATCH_SIZE) -> None:
    """Add the chunks that were never staged before to the run's work list.

    The ids already staged are looked up once, here, and not in every
    micro-batch: a batch then costs the same however long the ledger is.
    The files end after ``batch_size`` rows; the last one of a task is
    shorter.
    """
    spark = chunks.sparkSession
    if path_exists(spark, run.staged):
        chunks = pending_chunks(chunks, spark.read.schema(chunks.schema).parquet(run.staged))
    writer = chunks.write.mode("append").option("maxRecordsPerFile", batch_size)
    writer.option("compression", _CODEC).parquet(run.staged)


def process_staged(
    run: GenerationRun,
    spark: SparkSession,
    generator: str = "sentences",
    concurrency: int | None = None,
    timeout: int = fv.REQUEST_TIMEOUT_S,
    files_per_batch: int = 1,
) -> int | None:
    """Run the generator over everything staged and not yet done.

    One micro-batch takes ``files_per_batch`` chunk files; on a cluster give
    it as many as keep every caller busy.  ``concurrency`` limits the tasks that
    call at the same time; without it there are as many as Spark runs.  A failing generator ends the call
    with its error; finished micro-batches stay and the failed one is run
    again by the next call.  Returns the number of the last micro-batch, or
    nothing if there was nothing to do.
    """
    made_by = get_generator(generator)
    staged = (
        spark.readStream.schema(T.StructType([T.StructField(name, T.StringType()) for name in INPUT_COLUMNS]))
        .option("maxFilesPerTrigger", files_per_batch)
        # The source forgets files a week older than the newest one; a run
        # resumed after a break must still find its first ones.
        .option("maxFileAge", "36500d")
        .parquet(run.staged)
    )

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        rows = made_by.generate(batch, concurrency, timeout)
        rows.write.mode("overwrite").option("compression", _CODEC).parquet(f"{run.qa}/batch_id={batch_id}")
        batch.select("chunk_id").write.mode("overwrite").parquet(f"{run.ledger}/batch_id={batch_id}")

    query = (
        staged.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", run.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    worked = [progress["batchId"] for progress in query.recentProgress if progress["numInputRows"]]
    return worked[-1] if worked else None


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], with_batch)
    return spark.read.schema(with_batch).parquet(path)


def read_ledger(run: GenerationRun, spark: SparkSession) -> DataFrame:
    """``chunk_id, batch_id`` of the finished chunks."""
    return _read_or_empty(spark, run.ledger, T.StructType([T.StructField("chunk_id", T.StringType())]))


def read_generated(run: GenerationRun, spark: SparkSession, generator: str = "sentences", keep_cot: bool = False) -> DataFrame:
    """All rows of the run in the generator's declared schema, traces
    removed; no rows if nothing was generated."""
    rows = _read_or_empty(spark, run.qa, get_generator(generator).schema)
    return strip_traces(rows.drop("batch_id"), keep_cot)


def ledger_progress(chunks: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: batches done, last batch, chunks done, chunks in all."""
    nothing = F.lit(None).cast("long")
    done = ledger.select("batch_id", F.lit(1).alias("done"), F.lit(0).alias("known"))
    known = chunks.select(nothing.alias("batch_id"), F.lit(0).alias("done"), F.lit(1).alias("known"))
    per_batch = done.unionByName(known).groupBy("batch_id").agg(F.sum("done").alias("done"), F.sum("known").alias("known"))
    return per_batch.agg(
        F.count("batch_id").alias("batches_done"),
        F.max("batch_id").alias("last_batch"),
        F.coalesce(F.sum("done"), F.lit(0)).alias("chunks_done"),
        F.coalesce(F.sum("known"), F.lit(0)).alias("chunks_total"),
    )


def run_progress(run: GenerationRun, spark: SparkSession) -> DataFrame:
    """The same for a run, also while it is going on."""
    staged = _read_or_empty(spark, run.staged, T.StructType([T.StructField("chunk_id", T.StringType())]))
    return ledger_progress(staged, read_ledger(run, spark))


def resumable_generation(
    chunks: DataFrame,
    base: str,
    generator: str = "sentences",
    resume: bool = False,
    batch_size: int = fv.BATCH_SIZE,
    concurrency: int | None = None,
    timeout: int = fv.REQUEST_TIMEOUT_S,
    files_per_batch: int = 1,
    keep_cot: bool = False,
) -> DataFrame:
    """Stage, generate and read back in one call."""
    spark = chunks.sparkSession
    run = open_run(spark, base, resume)
    stage_chunks(run, chunks, batch_size)
    process_staged(run, spark, generator, concurrency, timeout, files_per_batch)
    return read_generated(run, spark, generator, keep_cot)
