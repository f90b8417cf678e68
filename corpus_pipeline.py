"""From raw documents to a training mix, a written table per stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table; ``run`` writes
it to the shared folder as Parquet and reads it back as the next one's
documents.  All stages but the last return the columns of ``docs``.  Rows
without an id pass the stages that compare documents unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from docloom.llm.decontaminate import drop_contaminated
from docloom.llm.id_filter import without_ids
from docloom.llm.mixing import curriculum_mix
from docloom.llm.ngram_join import ngram_jaccard_groups
from docloom.llm.pii import mask_personal_data
from docloom.llm.quality import keep_good
from docloom.llm.tables import saved, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules do not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; of rows
    that repeat an id, one."""
    groups = saved(ngram_jaccard_groups(docs.select("doc_id", "text")), "pipeline-groups")
    dropped = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("__dropped")).distinct()
    kept = without_ids(docs, saved(dropped, "pipeline-dropped"))
    repeated = groups.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__repeated"))
    repeated = saved(repeated, "pipeline-repeated")
    if repeated.isEmpty():
        return kept
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    is_repeated = kept["doc_id"].cast("long") == repeated["__repeated"]
    one = kept.join(repeated, is_repeated, "left_semi").withColumn("__rank", F.row_number().over(first))
    return kept.join(repeated, is_repeated, "left_anti").unionByName(one.where("__rank = 1").drop("__rank"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return mask_personal_data(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: a row per copy, sorted by training position."""
    return curriculum_mix(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("curriculum_mix", mixing),
]

#: None: rules, latent space and field are fitted, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
