"""Emergency calls: types, places and response times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.functions.clock import parse_call_moment, parse_day
from sparkwell.functions.patterns import CALL_DAY
from sparkwell.registry import query

# Fixed value: the busy type of call, under the name it has in the given tables.
BUSY_TYPE = "1-URGENT"


def of_type(calls: DataFrame, call_type: str) -> DataFrame:
    return calls.filter(F.col("CallType") == call_type).select("CallNumber", "AvailableDtTm", "CallType")


def with_moments(calls: DataFrame) -> DataFrame:
    """The three date texts replaced by timestamps, and the delay under its full name."""
    replaced = calls.withColumns(
        {
            "IncidentDate": parse_day(F.col("CallDate"), CALL_DAY),
            "OnWatchDate": parse_day(F.col("WatchDate"), CALL_DAY),
            "AvailableDtTS": parse_call_moment(F.col("AvailableDtTm")),
        }
    )
    return replaced.drop("CallDate", "WatchDate", "AvailableDtTm").withColumnRenamed("Delay", "DelayMinutes")


def known_types(calls: DataFrame) -> DataFrame:
    return calls.filter(F.col("CallType").isNotNull())


def counts(calls: DataFrame, *keys: str) -> DataFrame:
    """Calls of known type for each combination of ``keys``, most frequent first."""
    return known_types(calls).groupBy(*keys).count().orderBy(F.desc("count"), *keys)


def in_year(calls: DataFrame, year: int) -> DataFrame:
    return with_moments(calls).filter(F.year("IncidentDate") == year)


@query("fire_medical", "SELECT CallNumber, AvailableDtTm, CallType FROM v_call_records WHERE CallType = '1-URGENT'")
def fire_medical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of_type(views.call_records(spark, sf_dir), BUSY_TYPE)


@query("fire_call_type_count", "SELECT count(DISTINCT CallType) AS types FROM v_call_records WHERE CallType IS NOT NULL")
def fire_call_type_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_types(views.call_records(spark, sf_dir)).select("CallType").distinct().agg(F.count("*").alias("types"))


@query("fire_call_types", "SELECT DISTINCT CallType FROM v_call_records WHERE CallType IS NOT NULL")
def fire_call_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_types(views.call_records(spark, sf_dir)).select("CallType").distinct()


@query("fire_slow", "SELECT Address, Delay AS DelayMinutes FROM v_calls WHERE Delay > 5")
def fire_slow(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = views.calls(spark, sf_dir).withColumnRenamed("Delay", "DelayMinutes")
    return renamed.select("Address", "DelayMinutes").where(F.col("DelayMinutes") > 5)


@query(
    "fire_ts",
    """SELECT CallNumber, CallType, Address, Zipcode, NumAlarms, Neighborhood, Delay AS DelayMinutes,
              strptime(CallDate, '%m/%d/%Y')::TIMESTAMP AS IncidentDate,
              strptime(WatchDate, '%m/%d/%Y')::TIMESTAMP AS OnWatchDate,
              strptime(AvailableDtTm, '%m/%d/%Y %I:%M:%S %p')::TIMESTAMP AS AvailableDtTS FROM v_calls""",
)
def fire_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_moments(views.calls(spark, sf_dir))


@query(
    "fire_common_types",
    """SELECT CallType, count(*) AS "count" FROM v_call_records WHERE CallType IS NOT NULL GROUP BY CallType""",
)
def fire_common_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(views.call_records(spark, sf_dir), "CallType")


@query(
    "fire_type_zip",
    """SELECT CallType, Zipcode, count(*) AS "count" FROM v_call_records WHERE CallType IS NOT NULL GROUP BY CallType, Zipcode""",
)
def fire_type_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(views.call_records(spark, sf_dir), "CallType", "Zipcode")


@query("fire_two_zips", "SELECT DISTINCT Neighborhood, Zipcode FROM v_calls WHERE Zipcode = 94102 OR Zipcode = 94103")
def fire_two_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = (F.col("Zipcode") == 94102) | (F.col("Zipcode") == 94103)
    return views.calls(spark, sf_dir).select("Neighborhood", "Zipcode").filter(two).distinct()


@query(
    "fire_stats",
    """SELECT CAST(sum(NumAlarms) AS BIGINT) AS alarms, round(avg(Delay), 4) AS mean_delay, min(Delay) AS least_delay,
              max(Delay) AS greatest_delay FROM v_call_records""",
)
def fire_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.call_records(spark, sf_dir).agg(
        F.sum("NumAlarms").alias("alarms"),
        F.round(F.avg("Delay"), 4).alias("mean_delay"),
        F.min("Delay").alias("least_delay"),
        F.max("Delay").alias("greatest_delay"),
    )


@query("fire_years", "SELECT DISTINCT CAST(year(strptime(CallDate, '%m/%d/%Y')) AS INT) AS year FROM v_call_records")
def fire_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_moments(views.call_records(spark, sf_dir)).select(F.year("IncidentDate").alias("year")).distinct().orderBy("year")


@query(
    "fire_week_2018",
    """SELECT CAST(week(d) AS INT) AS week, count(*) AS "count"
       FROM (SELECT strptime(CallDate, '%m/%d/%Y') AS d FROM v_call_records) WHERE year(d) = 1998 GROUP BY ALL""",
)
def fire_week_2018(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The given tables end in 2001, so 1998 stands for the year in question.
    weekly = in_year(views.call_records(spark, sf_dir), 1998).groupBy(F.weekofyear("IncidentDate").alias("week")).count()
    return weekly.orderBy(F.desc("count"), "week")


@query(
    "fire_worst_2018",
    """SELECT Neighborhood, Delay AS DelayMinutes FROM v_calls WHERE year(strptime(CallDate, '%m/%d/%Y')) = 1998""",
)
def fire_worst_2018(spark: SparkSession, sf_dir: str) -> DataFrame:
    slowest = in_year(views.calls(spark, sf_dir), 1998).orderBy(F.desc("DelayMinutes"), "CallNumber")
    return slowest.select("Neighborhood", "DelayMinutes")
