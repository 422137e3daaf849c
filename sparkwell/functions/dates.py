"""Dates and times held as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.functions.clock import parse_call_moment, parse_day, parse_default, part
from sparkwell.functions.patterns import CALL_DAY
from sparkwell.registry import query
from sparkwell.tables import table


def readable_stamp(text: Column) -> Column:
    """``MMddHHmm`` as ``MM/dd HH:mm``."""
    parts = [F.substring(text, start, 2) for start in (1, 3, 5, 7)]
    return F.concat(parts[0], F.lit("/"), parts[1], F.lit(" "), parts[2], F.lit(":"), parts[3])


@query(
    "str_reformat_date",
    """SELECT date, concat(substr(date, 1, 2), '/', substr(date, 3, 2), ' ', substr(date, 5, 2), ':',
                           substr(date, 7, 2)) AS readable, count(*) AS n
       FROM v_stamps GROUP BY date""",
)
def str_reformat_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_stamp = views.stamps(spark, sf_dir).groupBy("date").agg(F.count("*").alias("n"))
    return per_stamp.withColumn("readable", readable_stamp(F.col("date")))


@query(
    "date_parse_patterns",
    """SELECT CallNumber, strptime(CallDate, '%m/%d/%Y')::TIMESTAMP AS called,
              strptime(AvailableDtTm, '%m/%d/%Y %I:%M:%S %p')::TIMESTAMP AS available FROM v_call_records""",
)
def date_parse_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.call_records(spark, sf_dir).select(
        "CallNumber",
        parse_day(F.col("CallDate"), CALL_DAY).alias("called"),
        parse_call_moment(F.col("AvailableDtTm")).alias("available"),
    )


@query("date_unpadded", "SELECT o_orderkey, CAST(date_trunc('second', o_orderdate) AS TIMESTAMP) AS placed FROM orders")
def date_unpadded(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.col("o_orderdate")
    day = F.concat_ws("-", F.year(moment).cast("string"), F.month(moment).cast("string"), F.day(moment).cast("string"))
    time = F.concat_ws(":", *[part(moment, letters) for letters in ("HH", "mm", "ss")])
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(" ", day, time).alias("text"))
    return texts.select("o_orderkey", parse_default(F.col("text")).alias("placed"))
