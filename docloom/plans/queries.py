"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.asciidoc import asciidoc_to_markdown, attribute_entries, clean_asciidoc
from docloom.functions.chunking import sections
from docloom.functions.messages import base_model
from docloom.functions.text import clean_technical
from docloom.operators import chunks as ck
from docloom.operators import compare, convert, corpus, generators, packing, qa
from docloom.plans import views
from docloom.session import qualified, work_dir
from docloom.sources import documents, sinks, tables
from docloom.streaming import generation

OUTLINE = "Reference manual"
SYSTEM_PROMPT = "You answer questions about the documentation."

Query = Callable[[SparkSession, str], DataFrame]


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ck.chunk_documents(views.md_documents(spark, sf_dir))


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated, named chunks: what a generator gets."""
    chunks = ck.dedup_chunks(_chunks(spark, sf_dir).select("doc_id", "pos", "chunk"))
    return ck.generator_input(chunks, outline=OUTLINE, generator="sentences")


def _messages_json(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.to_json("messages").alias("messages"))


# --- cleaning and chunking -------------------------------------------------


def q_clean_technical(spark, sf_dir):
    return views.md_documents(spark, sf_dir).select("doc_id", clean_technical(F.col("md")).alias("md"))


def q_clean_technical_strict(spark, sf_dir):
    return views.md_documents(spark, sf_dir).select("doc_id", clean_technical(F.col("md"), strict=True).alias("md"))


def q_split_sections(spark, sf_dir):
    cleaned = views.md_documents(spark, sf_dir).select("doc_id", clean_technical(F.col("md")).alias("md"))
    return cleaned.select("doc_id", F.posexplode(sections(F.col("md"))).alias("pos", "section"))


def q_chunk_documents(spark, sf_dir):
    return _chunks(spark, sf_dir)


def q_chunk_documents_small(spark, sf_dir):
    return ck.chunk_documents(views.md_documents(spark, sf_dir).drop("source"), max_chars=300)


def q_chunks_per_document(spark, sf_dir):
    return ck.chunks_per_document(views.md_documents(spark, sf_dir))


def q_chunk_counts(spark, sf_dir):
    return ck.chunk_counts(_chunks(spark, sf_dir))


def q_dedup_chunks(spark, sf_dir):
    return _inputs(spark, sf_dir).drop("chunk_id")


def q_source_metadata(spark, sf_dir):
    """Outline and domain looked up per source."""
    docs = views.table(spark, sf_dir, "documents")
    metadata = (
        docs.where("source <> 'src7'").groupBy("source")
        .agg(F.concat(F.lit("About "), F.col("source")).alias("document_outline"), F.min("lang").alias("domain"))
    )
    joined = ck.with_source_metadata(_chunks(spark, sf_dir).select("doc_id", "source", "pos", "chunk"), metadata)
    return joined.select("doc_id", "pos", F.col("chunk").alias("document"), "document_outline", "domain")


# --- documents -------------------------------------------------------------


def q_fingerprints(spark, sf_dir):
    return corpus.document_fingerprints(views.table(spark, sf_dir, "documents"))


def q_corpus_fingerprint(spark, sf_dir):
    return corpus.corpus_fingerprint(views.table(spark, sf_dir, "documents"))


def q_adoc_attributes(spark, sf_dir):
    docs = views.adoc_documents(spark, sf_dir)
    return docs.select("doc_id", F.posexplode(attribute_entries(F.col("text"))).alias("ord", "entry")).select(
        "doc_id", "ord", "entry.name", "entry.value"
    )


def q_adoc_attributes_across_lines(spark, sf_dir):
    docs = views.adoc_documents(spark, sf_dir)
    entries = attribute_entries(F.col("text"), across_lines=True)
    return docs.select("doc_id", F.posexplode(entries).alias("ord", "entry")).select(
        "doc_id", "ord", "entry.name", "entry.value"
    )


def q_adoc_clean(spark, sf_dir):
    return views.adoc_documents(spark, sf_dir).select("doc_id", clean_asciidoc(F.col("text")).alias("text"))


def q_adoc_clean_shared(spark, sf_dir):
    """With a table of shared attributes as long as that of the documents."""
    docs = views.adoc_documents(spark, sf_dir).selectExpr(*views.ADOC_SHARED_COLUMNS)
    table = views.documents_view(spark, sf_dir, views.SHARED_COLUMNS)
    known = convert.shared_attributes(docs, table, "doc_id")
    return known.select("doc_id", clean_asciidoc(F.col("text"), F.col("attributes")).alias("text"))


def q_adoc_to_markdown(spark, sf_dir):
    docs = views.adoc_markup(spark, sf_dir)
    return docs.select("doc_id", asciidoc_to_markdown(clean_asciidoc(F.col("text"))).alias("md"))


def _files(spark, sf_dir):
    """The documents as the bytes of files: some with other line ends, some
    that are not UTF-8."""
    content = """CASE WHEN doc_id % 50 = 7 THEN concat(X'FF', encode(text, 'UTF-8'))
      WHEN doc_id % 4 = 1 THEN encode(replace(text, chr(10), concat(chr(13), chr(10))), 'UTF-8')
      ELSE encode(text, 'UTF-8') END AS content"""
    return views.adoc_documents(spark, sf_dir).selectExpr("doc_id", "path", content)


def q_source_status(spark, sf_dir):
    files = convert.with_status(_files(spark, sf_dir).select("doc_id", "path"))
    return files.select("doc_id", "path", "ext", "status")


def q_decode_documents(spark, sf_dir):
    return convert.decode_documents(_files(spark, sf_dir)).select("doc_id", "text", "error")


def q_discover_documents(spark, sf_dir):
    """The documents as a tree of files, some with names that start with ``_``
    or ``.``, some in such folders: what is found of each, and what is read."""
    base = work_dir(spark, "tree")
    files = views.adoc_documents(spark, sf_dir).selectExpr(views.TREE_PATH, "encode(text, 'UTF-8') AS content")
    sinks.write_files(files, base)
    found = documents.discover_documents(spark, [base])
    read = documents.read_files(found.where("status = 'supported'"))
    digests = read.select("path", F.sha2("content", 256).alias("content_sha256"))
    relative = F.expr(f"substr(path, {len(qualified(spark, base)) + 2})")
    return found.join(digests, "path", "left").select(relative.alias("path"), "status", "length", "content_sha256")


def q_conversion_report(spark, sf_dir):
    return convert.conversion_report(convert.convert_documents(_files(spark, sf_dir)))


def q_merge_corpus(spark, sf_dir):
    return corpus.merge_documents(views.md_documents(spark, sf_dir), "source", "doc_id")


def q_merged_chunks(spark, sf_dir):
    """Chunks of each source's merged text; these may span documents."""
    return packing.merged_chunks(views.md_documents(spark, sf_dir), "source", "doc_id")


def q_last_per_basename(spark, sf_dir):
    docs = views.documents_view(spark, sf_dir, views.NAMED_COLUMNS)
    return corpus.latest_by_base_name(docs, order=("path", "doc_id")).select("base_name", "doc_id", "path", "md")


# --- generation ------------------------------------------------------------


def q_generate_qa(spark, sf_dir):
    return generators.generate_qa(_inputs(spark, sf_dir), "sentences")


def q_batch_plan(spark, sf_dir):
    return generation.batch_plan(_inputs(spark, sf_dir))


def _ledger(indexed):
    return indexed.where("batch_no % 2 = 0").select("chunk_id", F.col("batch_no").alias("batch_id"))


def q_resume_pending(spark, sf_dir):
    """Chunks left when those of every other document are done."""
    inputs = _inputs(spark, sf_dir)
    done = inputs.where("doc_id % 2 = 0").select("chunk_id")
    return generation.pending_chunks(inputs, done).select("chunk_id", "doc_id", "pos")


def q_generation_progress(spark, sf_dir):
    """Progress when every other batch is done."""
    indexed = generation.batch_index(_inputs(spark, sf_dir).select("chunk_id", "doc_id", "pos"))
    return generation.ledger_progress(indexed, _ledger(indexed))


def q_resumable_generation(spark, sf_dir):
    """The same rows as ``generate_qa``, by way of micro-batches."""
    cores = spark.sparkContext.defaultParallelism
    return generation.resumable_generation(
        _inputs(spark, sf_dir),
        work_dir(spark, "generation"),
        batch_size=20_000,
        concurrency=cores,
        files_per_batch=4 * cores,
    )


# --- finalize and export ---------------------------------------------------


def q_strip_traces(spark, sf_dir):
    return qa.strip_traces(views.qa_raw(spark, sf_dir))


def _valid(spark, sf_dir):
    return qa.valid_qa(q_strip_traces(spark, sf_dir))


def q_valid_qa(spark, sf_dir):
    return _valid(spark, sf_dir)


def q_qa_counts(spark, sf_dir):
    return qa.qa_counts(q_strip_traces(spark, sf_dir))


def q_chat_messages(spark, sf_dir):
    return _messages_json(qa.chat_rows(_valid(spark, sf_dir), SYSTEM_PROMPT, ["qa_id"]), "qa_id")


def q_chat_messages_no_system(spark, sf_dir):
    return _messages_json(qa.chat_rows(_valid(spark, sf_dir), "", ["qa_id"]), "qa_id")


def q_jsonl_round_trip(spark, sf_dir):
    path = work_dir(spark, "jsonl")
    sinks.write_chat_jsonl(q_strip_traces(spark, sf_dir), path, SYSTEM_PROMPT)
    return _messages_json(tables.read_chat_jsonl(spark, path))


def q_csv_round_trip(spark, sf_dir):
    path = work_dir(spark, "csv")
    sinks.write_csv(q_strip_traces(spark, sf_dir), path)
    return tables.read_qa_csv(spark, path, "qa_id bigint, question string, response string")


def q_prompt_messages(spark, sf_dir):
    questions = views.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("question"))
    return _messages_json(qa.prompt_rows(questions, SYSTEM_PROMPT, ["item_id"]), "item_id")


# --- comparison ------------------------------------------------------------


def q_side_by_side(spark, sf_dir):
    return compare.side_by_side(views.eval_answers(spark, sf_dir))


def q_join_answers(spark, sf_dir):
    answers = views.eval_answers(spark, sf_dir)
    return compare.join_answers(
        answers.where("model = 'reference' AND question_id % 6 <> 1"), answers.where("model = 'tuned'")
    )


def q_resolve_models(spark, sf_dir):
    configs = views.documents_view(spark, sf_dir, views.CONFIG_COLUMNS)
    return configs.select("doc_id", base_model(F.col("config"), F.col("override")).alias("base_model"))


def queries() -> dict[str, Query]:
    prefix = "q_"
    return {name.removeprefix(prefix): f for name, f in globals().items() if name.startswith(prefix)}
