"""Total orders and the first rows of them.

A sort ends with columns that tell rows apart, so that a frequent sort value can be cut
between range partitions and a limit always keeps the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.registry import query
from sparkwell.session import partitions_for, shuffle_partitions
from sparkwell.tables import table


def in_order(rows: DataFrame, order: list[str | Column], at_most: int) -> DataFrame:
    """``rows``, of which there are ``at_most`` that many, in total order: the ranges are as many as a task each can sort in memory."""
    spark = rows.sparkSession
    ranges = partitions_for(spark, at_most)
    if ranges > shuffle_partitions(spark):
        rows = rows.repartitionByRange(ranges, *order)  # the sort takes these ranges and shuffles no more
    return rows.orderBy(*order)


@query("sort_desc", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem")
def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return lines.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")


@query("sort_multi", "SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders")
def sort_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey")
    return priced.orderBy(F.asc("o_orderpriority"), F.desc("o_totalprice"), "o_orderkey")


@query(
    "topk_limit",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
)
def topk_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return priced.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "set_union_all",
    """SELECT * FROM v_flights WHERE origin = 'NATION_20' UNION ALL
       SELECT * FROM v_flights WHERE origin = 'NATION_20' AND destination = 'NATION_7' AND delay > 120""",
)
def set_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    departures = views.flights(spark, sf_dir).filter(F.col("origin") == "NATION_20")
    late = departures.filter("destination = 'NATION_7' AND delay > 120")
    return departures.union(late)
