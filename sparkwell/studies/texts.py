"""Lines of text: how many there are and how many hold a word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.registry import query


def lines_with(lines: DataFrame, word: str) -> DataFrame:
    return lines.filter(F.col("value").contains(word))


@query("text_line_count", "SELECT count(*) AS lines FROM v_text")
def text_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.text_lines(spark, sf_dir).agg(F.count("*").alias("lines"))


@query("text_contains_count", "SELECT count(*) AS lines FROM v_text WHERE contains(value, 'the')")
def text_contains_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_with(views.text_lines(spark, sf_dir), "the").agg(F.count("*").alias("lines"))
