"""The same question over the same people as Parquet, CSV and gzip CSV."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.registry import query
from sparkwell.sources.queries import PEOPLE, copy_as, csv_copy
from sparkwell.sources.readers import read_as, read_csv


def paid_above(people: DataFrame, bound: float = 10000) -> DataFrame:
    """Two columns are read; the salary is text, so the comparison casts it."""
    return people.select("gender", "salary").filter(F.col("salary").try_cast("double") > bound)


def people_in(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return read_as(spark, "parquet", copy_as(spark, sf_dir, "people", "parquet"))
    codec = "gzip" if fmt == "csv_gz" else "none"
    return read_csv(spark, csv_copy(spark, sf_dir, "people", sep=":", codec=codec), PEOPLE, sep=":")


@query(
    "fmt_salary_filter",
    """SELECT unnest(['parquet', 'csv', 'csv_gz']) AS format, n
       FROM (SELECT count(*) AS n FROM v_people WHERE TRY_CAST(salary AS DOUBLE) > 10000)""",
)
def fmt_salary_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        paid_above(people_in(spark, sf_dir, fmt)).agg(F.lit(fmt).alias("format"), F.count("*").alias("n"))
        for fmt in ("parquet", "csv", "csv_gz")
    ]
    return reduce(DataFrame.union, counts)
