"""People records: who is called what, who is young and well paid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.registry import query


def young_and_paid(
    this_year: int, under: int = 40, above: float = 80000, last: str = "J", first: str = "D"
) -> list[Column]:
    """Conditions in the order they are asked; only the year of birth counts for the age."""
    born = F.split_part("birthDate", F.lit("-"), F.lit(1)).try_cast("int")
    return [
        born > this_year - under,
        F.col("salary").try_cast("double") > above,
        F.col("lastName").startswith(last),
        F.col("firstName").startswith(first),
    ]


def named(people: DataFrame, first_name: str) -> DataFrame:
    return people.filter(F.col("firstName") == first_name)


@query("people_named", "SELECT count(*) AS n FROM (SELECT DISTINCT * FROM v_people WHERE firstName = 'Nell')")
def people_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(views.people(spark, sf_dir), "Nell").distinct().agg(F.count("*").alias("n"))


@query(
    "people_chain",
    """SELECT count(*) AS n FROM v_people
       WHERE year(CAST(birthDate AS DATE)) > 1984 AND TRY_CAST(salary AS DOUBLE) > 80000
         AND lastName LIKE 'J%' AND firstName LIKE 'D%'""",
)
def people_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = views.people(spark, sf_dir)
    for condition in young_and_paid(this_year=2024):
        kept = kept.filter(condition)
    return kept.agg(F.count("*").alias("n"))
