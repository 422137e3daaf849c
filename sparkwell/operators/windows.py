"""Ranking and last-value questions.

A window puts a whole group into one task, so each group is first reduced to a size that
does not follow the table: rank totals instead of rows, and take the last value with an
aggregate that combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.registry import query
from sparkwell.skew import attach_per_key
from sparkwell.tables import table


def top_by_dense_rank(totals: DataFrame, group: str, measure: str, top: int) -> DataFrame:
    """Rows whose measure is among the ``top`` greatest distinct values of their group."""
    order = Window.partitionBy(group).orderBy(F.desc(measure))
    return totals.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= top)


def latest(history: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """The value of each key's last record; the record id decides between equal dates."""
    return history.groupBy(key).agg(F.max_by(value, F.struct("to_date", "id")).alias(name))


def with_latest(history: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Every record beside the last value of its key: last() over the whole group."""
    return attach_per_key(history, latest(history, key, value, name), key, null_is_key=True)


@query(
    "win_dense_rank_top3",
    """SELECT origin, destination, total_delay, rank FROM (
         SELECT *, CAST(dense_rank() OVER (PARTITION BY origin ORDER BY total_delay DESC) AS INT) AS rank FROM (
           SELECT origin, destination, CAST(sum(delay) AS BIGINT) AS total_delay FROM v_flights GROUP BY ALL))
       WHERE rank <= 3""",
)
def win_dense_rank_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = views.flights(spark, sf_dir).groupBy("origin", "destination").agg(F.sum("delay").alias("total_delay"))
    return top_by_dense_rank(totals, "origin", "total_delay", 3)


@query(
    "win_rank_vs_dense",
    """SELECT p_brand, p_size, parts, CAST(rank() OVER w AS INT) AS rank, CAST(dense_rank() OVER w AS INT) AS dense
       FROM (SELECT p_brand, p_size, count(*) AS parts FROM part GROUP BY ALL)
       WINDOW w AS (PARTITION BY p_brand ORDER BY parts DESC)""",
)
def win_rank_vs_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_size = table(spark, sf_dir, "part").groupBy("p_brand", "p_size").agg(F.count("*").alias("parts"))
    order = Window.partitionBy("p_brand").orderBy(F.desc("parts"))
    return per_size.select(
        "p_brand", "p_size", "parts", F.rank().over(order).alias("rank"), F.dense_rank().over(order).alias("dense")
    )


@query(
    "win_last_value_range",
    "SELECT s.emp_no, s.id, s.salary, l.last_salary FROM v_salaries s JOIN v_last_salary l ON l.emp_no = s.emp_no",
)
def win_last_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = with_latest(views.salaries(spark, sf_dir), "emp_no", "salary", "last_salary")
    return paid.select("emp_no", "id", "salary", "last_salary")


@query("win_last_value_rows", "SELECT emp_no, last_title FROM v_last_title")
def win_last_value_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(views.titles(spark, sf_dir), "emp_no", "title", "last_title")


@query(
    "win_last_record",
    """SELECT emp_no, last_salary, last_title FROM v_last_salary JOIN v_last_title USING (emp_no)""",
)
def win_last_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    last_salary = latest(views.salaries(spark, sf_dir), "emp_no", "salary", "last_salary")
    last_title = latest(views.titles(spark, sf_dir), "emp_no", "title", "last_title")
    return last_salary.join(last_title, "emp_no").orderBy("emp_no")
