"""Functions over array columns, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.registry import query


def to_fahrenheit(celsius: Column) -> Column:
    """Whole degrees: multiply first, divide without remainder, then shift."""
    return F.transform(celsius, lambda t: F.call_function("div", t * 9, F.lit(5)) + 32)


def above(values: Column, bound: int) -> Column:
    return F.filter(values, lambda t: t > bound)


def holds(values: Column, wanted: int) -> Column:
    return F.exists(values, lambda t: t == wanted)


def mean_fahrenheit(celsius: Column) -> Column:
    """Mean of the readings in whole degrees Fahrenheit, each division dropping the remainder."""
    total = F.reduce(celsius, F.lit(0).cast("bigint"), lambda acc, t: acc + t)
    mean = F.call_function("div", total, F.size(celsius))
    return F.call_function("div", mean * 9, F.lit(5)) + 32


def regroup_plus_one(arrays: DataFrame) -> DataFrame:
    """Explode, add one to each element, and gather each id's elements again.

    A gathered list holds one source row's elements, so its size does not depend on the table.
    """
    single = arrays.select("id", F.explode("values").alias("value"))
    return single.groupBy("id").agg(F.sort_array(F.collect_list(F.col("value") + 1)).alias("plus_one"))


def as_text(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")


@query(
    "arr_explode_collect",
    """SELECT id, array_to_string(list_sort(list_transform("values", lambda v: v + 1)), ',') AS plus_one
       FROM v_arrays""",
)
def arr_explode_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    regrouped = regroup_plus_one(views.int_arrays(spark, sf_dir))
    return regrouped.select("id", as_text(F.col("plus_one")).alias("plus_one"))


@query(
    "arr_transform",
    """SELECT id, array_to_string(list_transform(celsius, lambda t: (t * 9) // 5 + 32), ',') AS fahrenheit
       FROM v_temps""",
)
def arr_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.temperatures(spark, sf_dir).select("id", as_text(to_fahrenheit(F.col("celsius"))).alias("fahrenheit"))


@query(
    "arr_filter",
    """SELECT id, coalesce(array_to_string(list_filter(celsius, lambda t: t > 38), ','), '') AS high FROM v_temps""",
)
def arr_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.temperatures(spark, sf_dir).select("id", as_text(above(F.col("celsius"), 38)).alias("high"))


@query("arr_exists", "SELECT id, list_contains(celsius, 38) AS has_threshold FROM v_temps")
def arr_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.temperatures(spark, sf_dir).select("id", holds(F.col("celsius"), 38).alias("has_threshold"))


@query(
    "arr_reduce",
    """SELECT id, CAST(((list_sum(celsius) // len(celsius)) * 9) // 5 + 32 AS BIGINT) AS mean_fahrenheit
       FROM v_temps""",
)
def arr_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.temperatures(spark, sf_dir).select("id", mean_fahrenheit(F.col("celsius")).alias("mean_fahrenheit"))
