"""Candy sales: how often each colour sells in each state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.operators.aggregates import summary
from sparkwell.registry import query


def sales_by(sales: DataFrame, *keys: str, descending: bool = True) -> DataFrame:
    """Number of sales for each combination of ``keys``, most (or least) frequent first."""
    total = F.desc("Total") if descending else F.asc("Total")
    return sales.groupBy(*keys).agg(F.count("Count").alias("Total")).orderBy(total, *keys)


def most_pieces(sales: DataFrame, *keys: str) -> DataFrame:
    most = sales.groupBy(*keys).agg(F.max("Count").alias("most"))
    return most.orderBy(F.desc("most"), *keys)


def in_state(sales: DataFrame, state: str) -> DataFrame:
    """The counts of one state; call once for each state of interest."""
    return sales_by(sales.filter(F.col("State") == state), "State", "Color")


@query("mnm_by_state_color", 'SELECT State, Color, count("Count") AS Total FROM v_sales GROUP BY State, Color')
def mnm_by_state_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by(views.sales(spark, sf_dir), "State", "Color")


@query("mnm_by_color", 'SELECT Color, count("Count") AS Total FROM v_sales GROUP BY Color')
def mnm_by_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by(views.sales(spark, sf_dir), "Color", descending=False)


@query("mnm_by_state", 'SELECT State, count("Count") AS Total FROM v_sales GROUP BY State')
def mnm_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by(views.sales(spark, sf_dir), "State")


@query("mnm_max", 'SELECT State, Color, max("Count") AS most FROM v_sales GROUP BY State, Color')
def mnm_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return most_pieces(views.sales(spark, sf_dir), "State", "Color")


@query(
    "mnm_one_state",
    """SELECT State, Color, count("Count") AS Total FROM v_sales WHERE State = 'A' GROUP BY State, Color""",
)
def mnm_one_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_state(views.sales(spark, sf_dir), "A")


@query(
    "mnm_summary",
    """SELECT State, Color, count("Count") AS n, avg("Count") AS mean, min("Count") AS least,
              max("Count") AS greatest FROM v_sales GROUP BY State, Color""",
)
def mnm_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(views.sales(spark, sf_dir), ["State", "Color"], "Count")
