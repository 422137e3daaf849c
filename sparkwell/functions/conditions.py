"""Row-wise classifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.registry import query

# Labels of the delay classes, longest first.
DELAY_LABELS = ("Very Long Delays", "Long Delays", "Short Delays", "Tolerable Delays", "No Delays")


def delay_class_open(delay: Column) -> Column:
    """Open intervals: a delay of exactly 360, 120 or 60 belongs to none and gets the last label."""
    very_long, long, short, tolerable, none = DELAY_LABELS
    return (
        F.when(delay > 360, very_long)
        .when((delay > 120) & (delay < 360), long)
        .when((delay > 60) & (delay < 120), short)
        .when((delay > 0) & (delay < 60), tolerable)
        .otherwise(none)
    )


def delay_class_stepped(delay: Column) -> Column:
    """Falling thresholds: a delay on a bound belongs to the class below it."""
    very_long, long, short, tolerable, none = DELAY_LABELS
    return (
        F.when(delay > 360, very_long).when(delay > 120, long).when(delay > 60, short).when(delay > 0, tolerable).otherwise(none)
    )


def on_time_status(delay: Column, tolerance: int = 10) -> Column:
    return F.when(delay <= tolerance, "On-time").otherwise("Delayed")


def usage_cost(used: Column, heavy_above: int = 750) -> Column:
    """Heavy users pay the lower rate per unit."""
    rate = F.when(used > heavy_above, F.lit(0.15)).otherwise(F.lit(0.50))
    return used * rate


@query(
    "case_status",
    """SELECT date, delay, distance, origin, destination,
              CASE WHEN delay <= 10 THEN 'On-time' ELSE 'Delayed' END AS status
       FROM v_flights WHERE origin = 'NATION_20' AND destination = 'NATION_7'""",
)
def case_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    route = views.flights(spark, sf_dir).filter("origin = 'NATION_20' AND destination = 'NATION_7'")
    return route.withColumn("status", on_time_status(F.col("delay")))
