"""Tables the operators read, and tables they keep between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the folder all executors share, and read back.

    Cuts the lineage: what is behind is not computed again, and a lost
    executor loses nothing of it.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
