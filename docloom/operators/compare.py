"""Two models' answers to the same questions, side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(
    answers: DataFrame,
    base: str = "reference",
    tuned: str = "tuned",
    question_id: str = "question_id",
) -> DataFrame:
    """One row per question from a long table of answers; null where a model
    gave none.  One shuffle, aggregated before it."""

    def answer_of(model: str):
        return F.max(F.when(F.col("model") == model, F.col("answer")))

    pivoted = answers.where(F.col("model").isin(base, tuned)).groupBy(question_id).agg(
        F.max("question").alias("question"),
        answer_of(base).alias("base_answer"),
        answer_of(tuned).alias("tuned_answer"),
    )
    return _with_verdict(pivoted)


def join_answers(base: DataFrame, tuned: DataFrame, question_id: str = "question_id") -> DataFrame:
    """The same from two tables with one answer per question."""
    left = base.select(question_id, F.col("question").alias("_bq"), F.col("answer").alias("base_answer"))
    right = tuned.select(question_id, F.col("question").alias("_tq"), F.col("answer").alias("tuned_answer"))
    joined = left.join(right, question_id, "full_outer").select(
        question_id, F.coalesce("_bq", "_tq").alias("question"), "base_answer", "tuned_answer"
    )
    return _with_verdict(joined)


def _with_verdict(df: DataFrame) -> DataFrame:
    missing = (
        F.when(F.col("base_answer").isNull() & F.col("tuned_answer").isNull(), "both")
        .when(F.col("base_answer").isNull(), "base")
        .when(F.col("tuned_answer").isNull(), "tuned")
        .otherwise("none")
    )
    return df.withColumn("missing_side", missing)
