"""Service usage: the heavy users and what each one pays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.functions.conditions import usage_cost
from sparkwell.registry import query


def heavy(usage: DataFrame, above: int = 900) -> DataFrame:
    return usage.filter(F.col("usage") > above).orderBy(F.desc("usage"), "uid")


@query("usage_heavy", "SELECT uid, uname, usage FROM v_usage WHERE usage > 900")
def usage_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy(views.usage(spark, sf_dir))


@query(
    "usage_cost",
    """SELECT uid, uname, usage,
              round(CASE WHEN usage > 750 THEN usage * 0.15::DOUBLE ELSE usage * 0.5::DOUBLE END, 4) AS cost FROM v_usage""",
)
def usage_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = usage_cost(F.col("usage"))
    return views.usage(spark, sf_dir).select("uid", "uname", "usage", F.round(priced, 4).alias("cost"))
