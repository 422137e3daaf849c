"""Flight delays: long legs, late routes, delay classes and the worst destinations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.functions.conditions import delay_class_open, delay_class_stepped
from sparkwell.operators.aggregates import MONTHS, as_doubles, delay_pivot
from sparkwell.operators.filters import HUB_DESTINATIONS, HUBS
from sparkwell.operators.sorting import in_order
from sparkwell.operators.windows import top_by_dense_rank
from sparkwell.registry import query


def route_delays(flights: DataFrame, origins: tuple[str, ...], destinations: tuple[str, ...]) -> DataFrame:
    """Summed delay of each route between the given ends."""
    between = flights.filter(F.col("origin").isin(*origins) & F.col("destination").isin(*destinations))
    return between.groupBy("origin", "destination").agg(F.sum("delay").alias("TotalDelays"))


def classified(legs: DataFrame, rule) -> DataFrame:
    """Legs with their delay class, worst first within each origin.

    The order ends with the leg itself: however many legs share a delay, a sort can cut between them.
    """
    ordered = in_order(legs, ["origin", F.desc("delay"), "destination", *views.LEG], legs.count())
    return ordered.select("delay", "origin", "destination", rule(F.col("delay")).alias("Flight_Delays"))


@query("flights_q1", "SELECT distance, origin, destination FROM v_flights WHERE distance > 1000")
def flights_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    legs = views.flight_legs(spark, sf_dir)
    long_legs = legs.filter(F.col("distance") > 1000)
    ordered = in_order(long_legs, [F.desc("distance"), "origin", "destination", *views.LEG], legs.count())
    return ordered.select("distance", "origin", "destination")


@query(
    "flights_q2",
    """SELECT date, delay, origin, destination FROM v_flights
       WHERE delay > 120 AND origin = 'NATION_20' AND destination = 'NATION_7'""",
)
def flights_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = (F.col("delay") > 120) & (F.col("origin") == "NATION_20") & (F.col("destination") == "NATION_7")
    found = views.flight_legs(spark, sf_dir).filter(late).orderBy(F.desc("delay"), "date", *views.LEG)
    return found.select("date", "delay", "origin", "destination")


@query(
    "flights_q3_case",
    """SELECT delay, origin, destination,
              CASE WHEN delay > 360 THEN 'Very Long Delays' WHEN delay > 120 AND delay < 360 THEN 'Long Delays'
                   WHEN delay > 60 AND delay < 120 THEN 'Short Delays'
                   WHEN delay > 0 AND delay < 60 THEN 'Tolerable Delays' ELSE 'No Delays' END AS Flight_Delays
       FROM v_flights""",
)
def flights_q3_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(views.flight_legs(spark, sf_dir), delay_class_open)


@query(
    "flights_q3_when",
    """SELECT delay, origin, destination,
              CASE WHEN delay > 360 THEN 'Very Long Delays' WHEN delay > 120 THEN 'Long Delays'
                   WHEN delay > 60 THEN 'Short Delays' WHEN delay > 0 THEN 'Tolerable Delays'
                   ELSE 'No Delays' END AS Flight_Delays
       FROM v_flights""",
)
def flights_q3_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(views.flight_legs(spark, sf_dir), delay_class_stepped)


@query(
    "flights_origin_view",
    """SELECT 'global' AS seen_in, date, delay, origin, destination FROM v_flights WHERE origin = 'NATION_12' UNION ALL
       SELECT 'session', date, delay, origin, destination FROM v_flights WHERE origin = 'NATION_20'""",
)
def flights_origin_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    legs = views.flights(spark, sf_dir).select("date", "delay", "origin", "destination")
    legs.filter("origin = 'NATION_12'").createOrReplaceGlobalTempView("sparkwell_from_one")
    legs.filter("origin = 'NATION_20'").createOrReplaceTempView("sparkwell_from_other")
    return spark.sql(
        "SELECT 'global' AS seen_in, * FROM global_temp.sparkwell_from_one "
        "UNION ALL SELECT 'session' AS seen_in, * FROM sparkwell_from_other"
    )


_HUBS = """FROM v_flights WHERE origin IN ('NATION_3', 'NATION_12', 'NATION_20')
           AND destination IN ('NATION_3', 'NATION_12', 'NATION_20', 'NATION_7', 'NATION_1', 'NATION_5', 'NATION_9')
           GROUP BY origin, destination"""


@query(
    "flights_top_routes",
    f"""SELECT origin, destination, CAST(sum(delay) AS BIGINT) AS TotalDelays {_HUBS}
        ORDER BY TotalDelays DESC, origin, destination LIMIT 10""",
)
def flights_top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = route_delays(views.flights(spark, sf_dir), HUBS, HUB_DESTINATIONS)
    return totals.orderBy(F.desc("TotalDelays"), "origin", "destination").limit(10)


@query(
    "flights_one_origin",
    """SELECT origin, destination, CAST(sum(delay) AS BIGINT) AS TotalDelays FROM v_flights
       WHERE origin = 'NATION_3' AND destination IN ('NATION_3', 'NATION_12', 'NATION_20', 'NATION_7', 'NATION_1',
                                                     'NATION_5', 'NATION_9')
       GROUP BY origin, destination ORDER BY TotalDelays DESC, destination LIMIT 10""",
)
def flights_one_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = route_delays(views.flights(spark, sf_dir), HUBS[:1], HUB_DESTINATIONS)
    return totals.orderBy(F.desc("TotalDelays"), "destination").limit(10)


@query(
    "flights_window_top3",
    f"""SELECT origin, destination, TotalDelays, rank FROM (
          SELECT *, CAST(dense_rank() OVER (PARTITION BY origin ORDER BY TotalDelays DESC) AS INT) AS rank
          FROM (SELECT origin, destination, CAST(sum(delay) AS BIGINT) AS TotalDelays {_HUBS}))
        WHERE rank <= 3""",
)
def flights_window_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = route_delays(views.flights(spark, sf_dir), HUBS, HUB_DESTINATIONS)
    return top_by_dense_rank(totals, "origin", "TotalDelays", 3)


@query(
    "flights_pivot",
    """SELECT destination,
              CAST(max(delay) FILTER (WHERE m = 1) AS DOUBLE) AS "JAN_MaxDelay",
              CAST(max(delay) FILTER (WHERE m = 2) AS DOUBLE) AS "FEB_MaxDelay",
              CAST(max(delay) FILTER (WHERE m = 3) AS DOUBLE) AS "MAR_MaxDelay",
              CAST(TRY_CAST(avg(delay) FILTER (WHERE m = 1) AS DECIMAL(10, 2)) AS DOUBLE) AS "JAN_AvgDelay",
              CAST(TRY_CAST(avg(delay) FILTER (WHERE m = 2) AS DECIMAL(10, 2)) AS DOUBLE) AS "FEB_AvgDelay",
              CAST(TRY_CAST(avg(delay) FILTER (WHERE m = 3) AS DECIMAL(10, 2)) AS DOUBLE) AS "MAR_AvgDelay"
       FROM (SELECT *, CAST(substr(date, 1, 2) AS INT) AS m FROM v_flights)
       WHERE origin = 'NATION_20' AND m IN (1, 2, 3) GROUP BY destination""",
)
def flights_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(delay_pivot(views.flights(spark, sf_dir), "NATION_20", MONTHS)).orderBy("destination")
