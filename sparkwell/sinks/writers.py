"""Writers, and one query for each: write the rows, read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import storage, views
from sparkwell.operators.aggregates import summary
from sparkwell.registry import query
from sparkwell.session import shuffle_partitions
from sparkwell.sources import readers
from sparkwell.studies.fire import with_moments
from sparkwell.tables import table


def save(rows: DataFrame, fmt: str, path: str, **options: str) -> None:
    """The number of files follows the number of partitions."""
    rows.write.format(fmt).mode("overwrite").options(**options).save(path)


def save_report(rows: DataFrame, keys: list[str], measure: str, fmt: str, path: str) -> None:
    """One file with a line for each combination of ``keys``: short by what it is, so one task can write it.

    The groups are counted before they are brought together; the rows themselves never meet.
    """
    save(summary(rows, keys, measure).coalesce(1), fmt, path)


def save_table(rows: DataFrame, name: str) -> None:
    rows.write.mode("overwrite").saveAsTable(name)


def files_of(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """(file, n): the rows in each file below ``path`` that has any."""
    return spark.read.format(fmt).load(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))


def round_trip(rows: DataFrame, fmt: str, schema: bool = False, **options: str) -> DataFrame:
    spark = rows.sparkSession
    path = storage.new_path(spark, f"sink-{fmt}")
    save(rows, fmt, path, **options)
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(rows.schema) if schema else reader).load(path)


@query("sink_parquet_roundtrip", "SELECT * FROM v_iot")
def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(views.iot(spark, sf_dir), "parquet")


@query("sink_parquet_snappy", "SELECT * FROM orders")
def sink_parquet_snappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "orders"), "parquet", compression="snappy")


@query(
    "sink_json_roundtrip",
    """SELECT Id, "First", "Last", Url, Published, Hits, array_to_string(Campaigns, ',') AS Campaigns FROM v_blogs""",
)
def sink_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = round_trip(views.blogs(spark, sf_dir), "json", schema=True)
    return back.withColumn("Campaigns", F.array_join("Campaigns", ","))


@query(
    "sink_csv_roundtrip",
    """SELECT CallNumber, CallType, Address, Zipcode, NumAlarms, Neighborhood, Delay AS DelayMinutes,
              strptime(CallDate, '%m/%d/%Y')::TIMESTAMP AS IncidentDate,
              strptime(WatchDate, '%m/%d/%Y')::TIMESTAMP AS OnWatchDate,
              strptime(AvailableDtTm, '%m/%d/%Y %I:%M:%S %p')::TIMESTAMP AS AvailableDtTS FROM v_calls""",
)
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(with_moments(views.calls(spark, sf_dir)), "csv", schema=True, header="true")


@query("sink_save_as_table", "SELECT * FROM v_flight_summary")
def sink_save_as_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fill(database: str) -> None:
        save_table(views.flight_summary(spark, sf_dir), f"{database}.flight_summary")

    return spark.table(f"{storage.database_for(spark, 'flight-summary', sf_dir, fill)}.flight_summary")


@query(
    "sink_ctas",
    """SELECT origin, destination, CAST(sum(delay) AS BIGINT) AS TotalDelays FROM v_flights
       WHERE origin IN ('NATION_3', 'NATION_12', 'NATION_20') GROUP BY origin, destination""",
)
def sink_ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fill(database: str) -> None:
        views.flights(spark, sf_dir).createOrReplaceTempView("sparkwell_flights")
        spark.sql(
            f"""CREATE TABLE {database}.hub_delays USING parquet AS
                SELECT origin, destination, sum(delay) AS TotalDelays FROM sparkwell_flights
                WHERE origin IN ('NATION_3', 'NATION_12', 'NATION_20') GROUP BY origin, destination"""
        )

    return spark.table(f"{storage.database_for(spark, 'hub-delays', sf_dir, fill)}.hub_delays")


@query(
    "sink_coalesce_one",
    """SELECT l_returnflag, l_linestatus, count(l_quantity) AS n, avg(l_quantity) AS mean,
              min(l_quantity) AS least, max(l_quantity) AS greatest FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def sink_coalesce_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.new_path(spark, "sink-one")
    save_report(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "parquet", path)
    return readers.read_as(spark, "parquet", path)


@query(
    "sink_files_per_partition",
    """SELECT CAST(times AS INTEGER) AS times, true AS a_file_each, true AS even, count(*) AS n
       FROM lineitem, (VALUES (1), (2), (4)) AS v (times) GROUP BY times""",
)
def sink_files_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written from 1, 2 and 4 times as many partitions as a shuffle has: a file for each, none with twice its share.

    Lines are dealt out evenly; fewer files are neighbouring partitions put together, without a shuffle.
    """
    least = max(16, shuffle_partitions(spark))

    def write(path: str) -> None:
        lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").repartition(4 * least)
        for times in (4, 2, 1):
            save(lines if times == 4 else lines.coalesce(times * least), "parquet", f"{path}/times={times}")

    path = storage.staged(spark, f"files-per-partition-{least}", sf_dir, write)
    each = files_of(spark, "parquet", path).withColumn("times", F.regexp_extract("file", r"/times=(\d+)/", 1).cast("int"))
    files = F.col("times") * least
    counted = each.groupBy("times").agg(F.count("*").alias("files"), F.max("n").alias("most"), F.sum("n").alias("n"))
    return counted.select("times", (F.col("files") == files).alias("a_file_each"), (F.col("most") * files < 2 * F.col("n")).alias("even"), "n")
