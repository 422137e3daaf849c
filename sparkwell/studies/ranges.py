"""Workloads over id ranges, joined to and filtered by the ids of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.registry import query
from sparkwell.tables import table

#: Wide enough for the sum of any ids; the same at every size.
SUM_TYPE = "decimal(38,0)"


def id_sum(ids: DataFrame) -> DataFrame:
    """The sum of all ids. Both halves of an id are summed as longs, and only the two sums are decimals."""
    high = F.sum(F.shiftright("id", 32)).cast(SUM_TYPE)
    low = F.sum(F.col("id").bitwiseAND(F.lit(0xFFFFFFFF))).cast(SUM_TYPE)
    return ids.agg((high * F.lit(2**32).cast("decimal(10,0)") + low).cast(SUM_TYPE).alias("total"))


def as_text(total: DataFrame) -> DataFrame:
    """All digits, which every client shows alike."""
    return total.select(F.col("total").cast("string").alias("total"))


def join_count(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, "id").agg(F.count("*").alias("n"))


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))


def known_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id from 0 to the largest order."""
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    return spark.range(0 if last is None else last + 1)


@query("range_sum", "SELECT CAST(CAST(sum(l_orderkey) AS HUGEINT) AS VARCHAR) AS total FROM lineitem")
def range_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(id_sum(order_ids(spark, sf_dir)))


@query(
    "range_join_count",
    """SELECT count(*) AS n FROM lineitem
       JOIN (SELECT unnest(range(0, (SELECT max(o_orderkey) + 1 FROM orders))) AS id) ON id = l_orderkey""",
)
def range_join_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_count(order_ids(spark, sf_dir), known_range(spark, sf_dir))


@query(
    "range_filter_sum",
    """SELECT CAST(CAST(sum(l_orderkey) AS HUGEINT) AS VARCHAR) AS total FROM lineitem
       WHERE l_orderkey > 100 AND l_orderkey % 2 = 0""",
)
def range_filter_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(id_sum(order_ids(spark, sf_dir).filter("id > 100 AND id % 2 = 0")))


@query(
    "agg_range_sum",
    """SELECT CAST(CAST(sum(id) AS HUGEINT) AS VARCHAR) AS total FROM orders
       JOIN (SELECT unnest(range(0, (SELECT max(o_orderkey) + 1 FROM orders))) AS id) ON id = o_orderkey WHERE id > 1000""",
)
def agg_range_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return as_text(id_sum(ids.join(known_range(spark, sf_dir), "id").filter(F.col("id") > 1000)))
