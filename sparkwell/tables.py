"""The given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkwell import storage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    storage.note_table(spark, path)
    return spark.read.parquet(path)
