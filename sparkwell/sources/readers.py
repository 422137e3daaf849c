"""Readers for files. A declared schema is preferred everywhere: inference reads the data twice."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Schema = str | T.StructType


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines end with a line feed, a carriage return or both."""
    return spark.read.text(path)


def read_gzip_text(spark: SparkSession, path: str) -> DataFrame:
    """Gzip files cannot be split, so where they are fewer than the cores the lines are spread."""
    lines = read_text(spark, path)
    cores = spark.sparkContext.defaultParallelism
    return lines if lines.rdd.getNumPartitions() >= cores else lines.repartition(cores)


def read_csv(
    spark: SparkSession, path: str, schema: Schema | None = None, sep: str = ",", strict: bool = False
) -> DataFrame:
    """CSV with a header. Without a schema types are inferred; ``strict`` fails on a malformed row."""
    reader = spark.read.option("header", True).option("sep", sep).option("nullValue", "")
    if strict:
        reader = reader.option("mode", "FAILFAST")
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    return (spark.read if schema is None else spark.read.schema(schema)).json(path)


def read_as(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """Formats that store their schema: parquet, orc, avro."""
    return spark.read.format(fmt).load(path)


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("image").load(folder)


def read_binary(spark: SparkSession, folder: str, glob: str, recursive: bool = False) -> DataFrame:
    """Whole files as bytes; a recursive look-up takes no partition columns from folder names."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(folder)


def view_on_files(spark: SparkSession, name: str, fmt: str, path: str, **options: str) -> None:
    """A SQL view straight on files."""
    given = ", ".join(f"{key} '{value}'" for key, value in {"path": path, **options}.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING {fmt} OPTIONS ({given})")


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value STRING").coalesce(1).write.text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).filter("value != ''").first()[0]))


def has_avro(spark: SparkSession) -> bool:
    """Whether the session was started with the separate Avro module."""
    try:
        spark.read.format("avro").schema("id LONG").load("/sparkwell/no/such/path")
    except AnalysisException as problem:
        return problem.getCondition() == "PATH_NOT_FOUND"
    return True
