"""Row filters. Every predicate is a column expression, so it can reach the Parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.registry import query
from sparkwell.studies import people
from sparkwell.tables import table

# The airports of interest, under the names they have in the given tables.
HUBS = ("NATION_3", "NATION_12", "NATION_20")
HUB_DESTINATIONS = ("NATION_3", "NATION_12", "NATION_20", "NATION_7", "NATION_1", "NATION_5", "NATION_9")


def all_of(rows: DataFrame, *conditions) -> DataFrame:
    """Successive filters: the same as one filter joined by AND."""
    return reduce(lambda kept, condition: kept.filter(condition), conditions, rows)


@query("filter_eq", """SELECT State, Color, "Count" FROM v_sales WHERE State = 'R'""")
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales(spark, sf_dir).where(F.col("State") == "R")


@query("filter_gt", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 50000")
def filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_extendedprice") > 50000)
    return lines.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "filter_and_or",
    """SELECT l_orderkey, l_linenumber FROM lineitem
       WHERE (l_returnflag = 'R' AND l_quantity > 25) OR (l_returnflag = 'A' AND l_quantity < 5)""",
)
def filter_and_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    either = ((flag == "R") & (quantity > 25)) | ((flag == "A") & (quantity < 5))
    return table(spark, sf_dir, "lineitem").filter(either).select("l_orderkey", "l_linenumber")


@query("filter_not_null", "SELECT CallNumber, CallType FROM v_call_records WHERE CallType IS NOT NULL")
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.call_records(spark, sf_dir).filter(F.col("CallType").isNotNull()).select("CallNumber", "CallType")


@query("filter_contains", "SELECT value FROM v_text WHERE contains(value, 'the')")
def filter_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.text_lines(spark, sf_dir).filter(F.col("value").contains("the"))


@query("filter_like", "SELECT * FROM v_flights WHERE date LIKE '01010%'")
def filter_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.flights(spark, sf_dir).filter(F.col("date").like("01010%"))


@query("filter_startswith", "SELECT id, firstName, lastName FROM v_people WHERE starts_with(lastName, 'J')")
def filter_startswith(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = views.people(spark, sf_dir).filter(F.col("lastName").startswith("J"))
    return named.select("id", "firstName", "lastName")


@query(
    "filter_in",
    """SELECT origin, destination, delay FROM v_flights WHERE origin IN ('NATION_3', 'NATION_12', 'NATION_20')""",
)
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.flights(spark, sf_dir).filter(F.col("origin").isin(*HUBS)).select("origin", "destination", "delay")


@query("filter_sql_string", "SELECT uid, usage FROM v_usage WHERE usage BETWEEN 100 AND 200 AND uname LIKE '%7'")
def filter_sql_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.usage(spark, sf_dir).filter("usage BETWEEN 100 AND 200 AND uname LIKE '%7'").select("uid", "usage")


@query(
    "filter_people_chain",
    """SELECT id, firstName, lastName, salary FROM v_people
       WHERE CAST(split_part(birthDate, '-', 1) AS INT) > 1984 AND TRY_CAST(salary AS DOUBLE) > 80000
         AND starts_with(lastName, 'J') AND starts_with(firstName, 'D')""",
)
def filter_people_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = all_of(views.people(spark, sf_dir), *people.young_and_paid(this_year=2024))
    return kept.select("id", "firstName", "lastName", "salary")
