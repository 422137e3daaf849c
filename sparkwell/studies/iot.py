"""Connected devices: heat, batteries and carbon dioxide."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.operators.aggregates import mean_of_numbers
from sparkwell.operators.projections import reshape
from sparkwell.registry import query

TEMP_BY_COUNTRY = "temp LONG, device_name STRING, device_id LONG, cca3 STRING"

_MEASURES = ("temp", "humidity", "c02_level", "battery_level")


def extremes(devices: DataFrame) -> DataFrame:
    found = [f(name).alias(f"{f.__name__}_{name}") for name in _MEASURES for f in (F.min, F.max)]
    return devices.agg(*found)


@query("iot_hot_humid", "SELECT * FROM v_iot WHERE temp > 30 AND humidity > 70")
def iot_hot_humid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.iot(spark, sf_dir).filter((F.col("temp") > 30) & (F.col("humidity") > 70))


@query("iot_temp_country", "SELECT temp, device_name, device_id, cca3 FROM v_iot WHERE temp > 25")
def iot_temp_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    warm = views.iot(spark, sf_dir).filter(F.col("temp") > 25)
    names = ("temp", "device_name", "device_id", "cca3")
    return reshape(warm, dict(zip(names, names)), TEMP_BY_COUNTRY)


@query("iot_temp_project", "SELECT temp, device_name, device_id, humidity, cca3, cn FROM v_iot WHERE temp > 25")
def iot_temp_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = views.iot(spark, sf_dir).select("temp", "device_name", "device_id", "humidity", "cca3", "cn")
    return shown.where("temp > 25")


@query("iot_low_battery", "SELECT battery_level, c02_level, device_name FROM v_iot WHERE battery_level < 8")
def iot_low_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = views.iot(spark, sf_dir).filter(F.col("battery_level") < 8)
    return low.orderBy("c02_level", "device_id").select("battery_level", "c02_level", "device_name")


@query(
    "iot_co2_country",
    """SELECT cn, avg(device_id) AS avg_device_id, avg(battery_level) AS avg_battery_level,
              avg(c02_level) AS avg_c02_level, avg(temp) AS avg_temp,
              avg(humidity) AS avg_humidity, avg(latitude) AS avg_latitude,
              avg(longitude) AS avg_longitude FROM v_iot WHERE c02_level > 1300 GROUP BY cn""",
)
def iot_co2_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    polluting = views.iot(spark, sf_dir).filter(F.col("c02_level") > 1300)
    return mean_of_numbers(polluting, "cn").orderBy(F.desc("avg_c02_level"), "cn")


@query(
    "iot_hot_country",
    """SELECT cn, avg(temp) AS avg_temp, avg(humidity) AS avg_humidity
       FROM v_iot WHERE temp > 25 AND humidity > 75 GROUP BY cn""",
)
def iot_hot_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    sultry = views.iot(spark, sf_dir).filter("temp > 25 AND humidity > 75").select("temp", "humidity", "cn")
    return mean_of_numbers(sultry, "cn").orderBy(F.desc("avg_temp"), F.desc("avg_humidity"), "cn")


@query(
    "iot_min_max",
    """SELECT min(temp) AS min_temp, max(temp) AS max_temp, min(humidity) AS min_humidity, max(humidity) AS max_humidity,
              min(c02_level) AS min_c02_level, max(c02_level) AS max_c02_level,
              min(battery_level) AS min_battery_level, max(battery_level) AS max_battery_level FROM v_iot""",
)
def iot_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extremes(views.iot(spark, sf_dir))
