"""Grouped and global aggregates, pivots, rollups and cubes.

All of them combine before the shuffle, so a frequent group costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwell import views
from sparkwell.functions.arrays import as_text
from sparkwell.registry import query
from sparkwell.tables import table

# Names of the months the delay pivot can show.
MONTHS = {"JAN": 1, "FEB": 2, "MAR": 3}


def summary(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, mean, least and greatest value for each group."""
    return rows.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.min(value).alias("least"),
        F.max(value).alias("greatest"),
    )


def mean_of_numbers(rows: DataFrame, key: str) -> DataFrame:
    """The mean of every numeric column but the key, each under ``avg_<column>``."""
    numeric = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != key]
    return rows.groupBy(key).agg(*[F.avg(name).alias(f"avg_{name}") for name in numeric])


def delay_pivot(
    flights: DataFrame, origin: str, months: Mapping[str, int], mean_type: str = "decimal(10,2)"
) -> DataFrame:
    """Per destination, mean and greatest delay in a column pair for each named month.

    A mean that does not fit ``mean_type`` is null. Months not named are dropped.
    """
    month = F.substring("date", 1, 2).cast("int")
    spelled = F.create_map(*[F.lit(x) for name, number in months.items() for x in (number, name)])
    shown = flights.filter((F.col("origin") == origin) & month.isin(*months.values()))
    return (
        shown.select("destination", "delay", spelled[month].alias("month"))
        .groupBy("destination")
        .pivot("month", list(months))
        .agg(F.avg("delay").try_cast(mean_type).alias("AvgDelay"), F.max("delay").alias("MaxDelay"))
    )


def as_doubles(pivoted: DataFrame) -> DataFrame:
    """The pivot with plain numbers, which every client shows alike where some are null."""
    return pivoted.select("destination", *[F.col(name).cast("double").alias(name) for name in pivoted.columns[1:]])


@query("agg_count_all", "SELECT count(*) AS n FROM lineitem")
def agg_count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@query("agg_count_by_two", 'SELECT State, Color, count("Count") AS n FROM v_sales GROUP BY State, Color')
def agg_count_by_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales(spark, sf_dir).groupBy("State", "Color").agg(F.count("Count").alias("n"))


@query("agg_count_by_one", 'SELECT Color, count("Count") AS n FROM v_sales GROUP BY Color')
def agg_count_by_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales(spark, sf_dir).groupBy("Color").agg(F.count("Count").alias("n"))


@query("agg_max_by", 'SELECT State, Color, max("Count") AS most FROM v_sales GROUP BY State, Color')
def agg_max_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales(spark, sf_dir).groupBy("State", "Color").agg(F.max("Count").alias("most"))


@query(
    "agg_summary_by",
    """SELECT l_suppkey, count(l_quantity) AS n, avg(l_quantity) AS mean,
              min(l_quantity) AS least, max(l_quantity) AS greatest FROM lineitem GROUP BY l_suppkey""",
)
def agg_summary_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_quantity")


@query("agg_group_count", 'SELECT o_orderpriority, count(*) AS "count" FROM orders GROUP BY o_orderpriority')
def agg_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").count()


@query(
    "agg_global",
    """SELECT round(sum(l_quantity), 4) AS total, round(avg(l_discount), 4) AS mean_discount,
              min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem""",
)
def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(
        F.round(F.sum("l_quantity"), 4).alias("total"),
        F.round(F.avg("l_discount"), 4).alias("mean_discount"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "agg_avg_all_numeric",
    """SELECT cn, avg(device_id) AS avg_device_id, avg(battery_level) AS avg_battery_level,
              avg(c02_level) AS avg_c02_level, avg(temp) AS avg_temp,
              avg(humidity) AS avg_humidity, avg(latitude) AS avg_latitude,
              avg(longitude) AS avg_longitude FROM v_iot GROUP BY cn""",
)
def agg_avg_all_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_of_numbers(views.iot(spark, sf_dir), "cn")


@query("agg_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("agg_count_distinct", "SELECT count(DISTINCT CallType) AS n FROM v_call_records WHERE CallType IS NOT NULL")
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = views.call_records(spark, sf_dir).filter(F.col("CallType").isNotNull())
    return known.agg(F.countDistinct("CallType").alias("n"))


@query(
    "agg_sum_by",
    "SELECT origin, destination, CAST(sum(delay) AS BIGINT) AS total_delay FROM v_flights GROUP BY origin, destination",
)
def agg_sum_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.flights(spark, sf_dir).groupBy("origin", "destination").agg(F.sum("delay").alias("total_delay"))


@query(
    "agg_collect_list",
    """SELECT l_suppkey, array_to_string(list_sort(list(q)), ',') AS quantities, CAST(sum(n) AS BIGINT) AS lines
       FROM (SELECT l_suppkey, l_quantity AS q, count(*) AS n FROM lineitem GROUP BY ALL)
       GROUP BY l_suppkey""",
)
def agg_collect_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One element for each distinct quantity: a list stays short however many lines a supplier has.
    lines = table(spark, sf_dir, "lineitem")
    per_quantity = lines.groupBy("l_suppkey", F.col("l_quantity").alias("q")).agg(F.count("*").alias("n"))
    return per_quantity.groupBy("l_suppkey").agg(
        as_text(F.sort_array(F.collect_list("q"))).alias("quantities"), F.sum("n").alias("lines")
    )


def _pivot_sql(months: Sequence[str]) -> str:
    pairs = [
        f"""CAST(TRY_CAST(avg(delay) FILTER (WHERE m = {MONTHS[name]}) AS DECIMAL(10, 2)) AS DOUBLE) AS "{name}_AvgDelay",
            CAST(max(delay) FILTER (WHERE m = {MONTHS[name]}) AS DOUBLE) AS "{name}_MaxDelay" """
        for name in months
    ]
    wanted = ", ".join(str(MONTHS[name]) for name in months)
    return f"""SELECT destination, {", ".join(pairs)}
               FROM (SELECT *, CAST(substr(date, 1, 2) AS INT) AS m FROM v_flights)
               WHERE origin = 'NATION_3' AND m IN ({wanted}) GROUP BY destination"""


def _pivot(spark: SparkSession, sf_dir: str, months: Sequence[str]) -> DataFrame:
    flights = views.flights(spark, sf_dir)
    return as_doubles(delay_pivot(flights, "NATION_3", {name: MONTHS[name] for name in months}))


@query("agg_pivot_three", _pivot_sql(["JAN", "FEB", "MAR"]))
def agg_pivot_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot(spark, sf_dir, ["JAN", "FEB", "MAR"])


@query("agg_pivot_two", _pivot_sql(["JAN", "FEB"]))
def agg_pivot_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot(spark, sf_dir, ["JAN", "FEB"])


@query(
    "agg_rollup",
    """SELECT State, Color, CAST(GROUPING(State, Color) AS BIGINT) AS level, CAST(sum("Count") AS BIGINT) AS pieces
       FROM v_sales GROUP BY ROLLUP (State, Color)""",
)
def agg_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        views.sales(spark, sf_dir)
        .rollup("State", "Color")
        .agg(F.grouping_id().alias("level"), F.sum("Count").alias("pieces"))
    )


@query(
    "agg_cube",
    """SELECT State, Color, CAST(GROUPING(State, Color) AS BIGINT) AS level, CAST(sum("Count") AS BIGINT) AS pieces
       FROM v_sales GROUP BY CUBE (State, Color)""",
)
def agg_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        views.sales(spark, sf_dir)
        .cube("State", "Color")
        .agg(F.grouping_id().alias("level"), F.sum("Count").alias("pieces"))
    )
