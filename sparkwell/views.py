"""Input datasets of the case studies, derived from the given tables.

Each view has a DataFrame form and the same definition in DuckDB SQL (``VIEW_SQL``), which
the oracle queries use. All arithmetic is exact in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import storage
from sparkwell.functions.clock import call_text, compact_text, day_text, log_text
from sparkwell.functions.patterns import LOG_LINE
from sparkwell.session import shuffles_for
from sparkwell.skew import broadcast_if_small
from sparkwell.tables import table


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candy sales: one row per sale with the state, the colour and how many pieces."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("State"),
        F.col("l_linestatus").alias("Color"),
        F.floor("l_quantity").cast("int").alias("Count"),
    )


def blogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blog authors with the hits of their page and the campaigns it ran in."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("Id"),
        F.col("c_mktsegment").alias("First"),
        F.col("c_name").alias("Last"),
        F.concat(F.lit("https://blog"), (k % 50).cast("string"), F.lit(".example.com")).alias("Url"),
        F.concat((k % 12 + 1).cast("string"), F.lit("/"), (k % 28 + 1).cast("string"), F.lit("/2016")).alias(
            "Published"
        ),
        ((k * 7919) % 50000).alias("Hits"),
        F.when(k % 3 == 0, F.array(F.lit("twitter"), F.lit("LinkedIn")))
        .when(k % 3 == 1, F.array(F.lit("web"), F.lit("twitter"), F.lit("FB")))
        .otherwise(F.array(F.lit("twitter"), F.lit("FB")))
        .alias("Campaigns"),
    )


def _call_columns() -> list[Column]:
    o = F.col("o_orderkey")
    day = day_text(F.col("o_orderdate"))
    available = F.expr("timestampadd(SECOND, CAST(o_orderkey % 86400 AS INT), o_orderdate)")
    return [
        o.alias("CallNumber"),
        F.when(o % 53 != 0, F.col("o_orderpriority")).alias("CallType"),
        day.alias("CallDate"),
        day.alias("WatchDate"),
        call_text(available).alias("AvailableDtTm"),
        (F.col("o_custkey") % 30 + 94100).cast("int").alias("Zipcode"),
        (o % 5 + 1).cast("int").alias("NumAlarms"),
        F.round((o % 1000) / F.lit(60.0), 4).alias("Delay"),
    ]


def call_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emergency calls with their dates as text, without the place, which takes two joins."""
    return table(spark, sf_dir, "orders").select(*_call_columns())


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emergency calls with their dates as text and their place, the way a CSV file holds them."""
    placed = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    number, kind, called, watched, available, zipcode, alarms, delay = _call_columns()
    return placed.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        number,
        kind,
        called,
        watched,
        available,
        F.col("c_name").alias("Address"),
        zipcode,
        alarms,
        F.col("n_name").alias("Neighborhood"),
        delay,
    )


def call_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of a call, the way the file of the calls declares them."""
    n = F.col("CallNumber")
    text = lambda prefix, of: F.concat(F.lit(prefix), (n % of).cast("string"))
    return calls(spark, sf_dir).select(
        "CallNumber",
        text("E", 97).alias("UnitID"),
        (n + 1000).alias("IncidentNumber"),
        "CallType",
        "CallDate",
        "WatchDate",
        F.when(n % 7 == 0, "Other").otherwise("Fire").alias("CallFinalDisposition"),
        "AvailableDtTm",
        "Address",
        text("City ", 3).alias("City"),
        "Zipcode",
        text("B", 10).alias("Battalion"),
        text("", 50).alias("StationArea"),
        text("Box", 1000).alias("Box"),
        text("", 4).alias("OriginalPriority"),
        text("", 3).alias("Priority"),
        (n % 3 + 1).cast("int").alias("FinalPriority"),
        (n % 2 == 0).alias("ALSUnit"),
        F.when(n % 5 != 0, text("Group ", 4)).alias("CallTypeGroup"),
        "NumAlarms",
        text("TYPE", 6).alias("UnitType"),
        (n % 9 + 1).cast("int").alias("UnitSequenceInCallDispatch"),
        text("", 11).alias("FirePreventionDistrict"),
        text("", 12).alias("SupervisorDistrict"),
        "Neighborhood",
        F.concat(F.lit("("), (n % 90).cast("string"), F.lit(", -"), (n % 180).cast("string"), F.lit(")")).alias("Location"),
        F.concat(n.cast("string"), F.lit("-"), text("E", 97)).alias("RowID"),
        F.col("Delay").cast("float").alias("Delay"),
    )


def stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The departure text of every flight leg, which needs no join."""
    return table(spark, sf_dir, "lineitem").select(compact_text(F.col("l_shipdate")).alias("date"))


def iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of connected devices."""
    e = F.col("event_id")
    country = F.concat(F.lit("C"), (F.col("user_id") % 25).cast("string"))
    return table(spark, sf_dir, "events").select(
        e.alias("device_id"),
        F.concat(F.lit("dev-"), F.col("user_id").cast("string")).alias("device_name"),
        (e % 10).alias("battery_level"),
        (e % 800 + 800).alias("c02_level"),
        (e % 25 + 10).alias("temp"),
        (e % 75 + 25).alias("humidity"),
        ((e % 721 - 360) / F.lit(4.0)).alias("latitude"),
        ((e % 1441 - 720) / F.lit(4.0)).alias("longitude"),
        country.alias("cca3"),
        country.alias("cn"),
    )


LEG = ("l_orderkey", "l_linenumber", "l_partkey")
LEG_SCHEMA = "date string, delay int, distance int, origin string, destination string, l_orderkey bigint, l_linenumber int, l_partkey bigint"


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight legs: departure text ``MMddHHmm``, delay, distance and both ends."""
    return flight_legs(spark, sf_dir).drop(*LEG)


def flight_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights with the columns that tell two legs apart, for sorting; joined once per application and state of the tables."""

    def write(path: str) -> None:
        with shuffles_for(spark, table(spark, sf_dir, "lineitem").count()):
            _joined_legs(spark, sf_dir).write.parquet(path)

    return spark.read.schema(LEG_SCHEMA).parquet(storage.staged(spark, "flight-legs", sf_dir, write))


def _joined_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines are shuffled once, to meet their orders: suppliers go to them while small, and nations, as keys, get their names last."""

    def named(key: str, name: str) -> DataFrame:
        return broadcast_if_small(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name)))

    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    placed = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(broadcast_if_small(suppliers, max_rows=1_000_000), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(named("s_nationkey", "origin"), "s_nationkey")
        .join(named("c_nationkey", "destination"), "c_nationkey")
        .select(
            compact_text(F.col("l_shipdate")).alias("date"),
            F.datediff("l_shipdate", "o_orderdate").alias("delay"),
            F.floor(F.col("l_extendedprice") / 10).cast("int").alias("distance"),
            "origin",
            "destination",
            *LEG,
        )
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("IATA"), F.col("n_name").alias("City"), F.col("r_name").alias("State"))
    )


def flight_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights between each pair of countries."""
    return (
        flights(spark, sf_dir)
        .groupBy(F.col("destination").alias("DEST_COUNTRY_NAME"), F.col("origin").alias("ORIGIN_COUNTRY_NAME"))
        .agg(F.count("*").alias("count"))
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("uid"), F.col("c_name").alias("uname"), ((k * 7919) % 1000).cast("int").alias("usage")
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People with every number as text, the way an untyped CSV file holds them."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("id"),
        F.when(k % 5 == 0, "Nell")
        .when(k % 5 == 1, "Dana")
        .when(k % 5 == 2, "Dora")
        .when(k % 5 == 3, "Ana")
        .otherwise("Eve")
        .alias("firstName"),
        F.col("c_mktsegment").alias("middleName"),
        F.when(k % 3 == 0, "Jones").when(k % 3 == 1, "James").otherwise("Smith").alias("lastName"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat((k % 60 + 1950).cast("string"), F.lit("-06-15")).alias("birthDate"),
        F.concat(F.lit("900-"), (k % 10000).cast("string")).alias("ssn"),
        ((k * 977) % 150000).cast("string").alias("salary"),
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("emp_no"), F.col("c_name").alias("name"))


def hr_records(spark: SparkSession, sf_dir: str, source: str, value: str) -> DataFrame:
    """A dated history of one attribute: ``emp_no, id, to_date`` and the attribute as ``value``."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("emp_no"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("to_date"),
        F.col(source).alias(value),
    )


def salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hr_records(spark, sf_dir, "o_totalprice", "salary")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hr_records(spark, sf_dir, "o_orderpriority", "title")


def dept_emp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hr_records(spark, sf_dir, "o_orderstatus", "dept_no")


def grouped_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id"), F.col("l_quantity").alias("v"))


def int_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One short array of integers per id."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("id"), F.array(*[(k % 10 + i).cast("int") for i in (1, 2, 3)]).alias("values")
    )


def temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five or seven Celsius readings per device."""
    e = F.col("event_id")
    seven = [((e * 7 + 13 * i) % 31 + 29).cast("int") for i in range(7)]
    return table(spark, sf_dir, "events").select(
        e.alias("id"),
        F.when(e % 2 == 0, F.array(*seven)).otherwise(F.array(*seven[:5])).alias("celsius"),
    )


def squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id") % 10000
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), (n * n).alias("square")
    )


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document."""
    return table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A web-server log in common log format; a few lines are not in that format."""
    e = F.col("event_id")
    line = F.concat(
        F.lit("host"),
        F.col("user_id").cast("string"),
        F.lit(".example.com - - ["),
        log_text(F.col("ts")),
        F.lit(' -0400] "'),
        F.when(F.col("event_type") == "error", "POST").when(e % 13 == 1, "HEAD").when(e % 13 == 2, "PUT").otherwise("GET"),
        F.lit(" /"),
        F.col("event_type"),
        F.lit("/"),
        (e % 50).cast("string"),
        F.lit(" "),
        F.when(e % 11 == 1, "HTTP/1.1").when(e % 11 == 2, "HTTP/V1.0").when(e % 11 == 3, "STS-69</a><p>").otherwise("HTTP/1.0"),
        F.lit('" '),
        F.when(F.col("event_type") == "error", "404")
        .when(e % 17 == 1, "304")
        .when(e % 17 == 2, "302")
        .when(e % 17 == 3, "500")
        .otherwise("200"),
        F.lit(" "),
        F.when(e % 10 == 0, "-").otherwise(F.floor(F.col("value") * 100).cast("string")),
    )
    either = F.when(e % 97 == 0, F.concat(F.lit("garbage "), e.cast("string"))).otherwise(line)
    # Exploding one element makes the line a source column: a filter on it does not build it again.
    return table(spark, sf_dir, "events").select(F.explode(F.array(either)).alias("value"))


VIEW_SQL: dict[str, str] = {
    "v_sales": """
        SELECT l_returnflag AS State, l_linestatus AS Color, CAST(floor(l_quantity) AS INT) AS "Count"
        FROM lineitem""",
    "v_blogs": """
        SELECT c_custkey AS Id, c_mktsegment AS "First", c_name AS "Last",
               concat('https://blog', c_custkey % 50, '.example.com') AS Url,
               concat(c_custkey % 12 + 1, '/', c_custkey % 28 + 1, '/2016') AS Published,
               (c_custkey * 7919) % 50000 AS Hits,
               CASE c_custkey % 3 WHEN 0 THEN ['twitter', 'LinkedIn'] WHEN 1 THEN ['web', 'twitter', 'FB']
                    ELSE ['twitter', 'FB'] END AS Campaigns
        FROM customer""",
    "v_calls": """
        SELECT o_orderkey AS CallNumber,
               CASE WHEN o_orderkey % 53 <> 0 THEN o_orderpriority END AS CallType,
               strftime(o_orderdate, '%m/%d/%Y') AS CallDate,
               strftime(o_orderdate, '%m/%d/%Y') AS WatchDate,
               strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%m/%d/%Y %I:%M:%S %p') AS AvailableDtTm,
               c_name AS Address,
               CAST(o_custkey % 30 + 94100 AS INT) AS Zipcode,
               CAST(o_orderkey % 5 + 1 AS INT) AS NumAlarms,
               n_name AS Neighborhood,
               round((o_orderkey % 1000) / 60.0::DOUBLE, 4) AS Delay
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "v_call_records": """
        SELECT o_orderkey AS CallNumber,
               CASE WHEN o_orderkey % 53 <> 0 THEN o_orderpriority END AS CallType,
               strftime(o_orderdate, '%m/%d/%Y') AS CallDate,
               strftime(o_orderdate, '%m/%d/%Y') AS WatchDate,
               strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%m/%d/%Y %I:%M:%S %p') AS AvailableDtTm,
               CAST(o_custkey % 30 + 94100 AS INT) AS Zipcode,
               CAST(o_orderkey % 5 + 1 AS INT) AS NumAlarms,
               round((o_orderkey % 1000) / 60.0::DOUBLE, 4) AS Delay
        FROM orders""",
    "v_call_rows": """
        SELECT CallNumber, concat('E', CallNumber % 97) AS UnitID, CallNumber + 1000 AS IncidentNumber, CallType, CallDate,
               WatchDate, CASE WHEN CallNumber % 7 = 0 THEN 'Other' ELSE 'Fire' END AS CallFinalDisposition, AvailableDtTm,
               Address, concat('City ', CallNumber % 3) AS City, Zipcode, concat('B', CallNumber % 10) AS Battalion,
               CAST(CallNumber % 50 AS VARCHAR) AS StationArea, concat('Box', CallNumber % 1000) AS Box,
               CAST(CallNumber % 4 AS VARCHAR) AS OriginalPriority, CAST(CallNumber % 3 AS VARCHAR) AS Priority,
               CAST(CallNumber % 3 + 1 AS INT) AS FinalPriority, CallNumber % 2 = 0 AS ALSUnit,
               CASE WHEN CallNumber % 5 <> 0 THEN concat('Group ', CallNumber % 4) END AS CallTypeGroup, NumAlarms,
               concat('TYPE', CallNumber % 6) AS UnitType, CAST(CallNumber % 9 + 1 AS INT) AS UnitSequenceInCallDispatch,
               CAST(CallNumber % 11 AS VARCHAR) AS FirePreventionDistrict,
               CAST(CallNumber % 12 AS VARCHAR) AS SupervisorDistrict, Neighborhood,
               concat('(', CallNumber % 90, ', -', CallNumber % 180, ')') AS Location,
               concat(CallNumber, '-E', CallNumber % 97) AS RowID, CAST(CAST(Delay AS FLOAT) AS DOUBLE) AS Delay
        FROM v_calls""",
    "v_stamps": "SELECT strftime(l_shipdate, '%m%d%H%M') AS date FROM lineitem",
    "v_iot": """
        SELECT event_id AS device_id, concat('dev-', user_id) AS device_name, event_id % 10 AS battery_level,
               event_id % 800 + 800 AS c02_level, event_id % 25 + 10 AS temp, event_id % 75 + 25 AS humidity,
               (event_id % 721 - 360) / 4.0::DOUBLE AS latitude, (event_id % 1441 - 720) / 4.0::DOUBLE AS longitude,
               concat('C', user_id % 25) AS cca3, concat('C', user_id % 25) AS cn
        FROM events""",
    "v_flights": """
        SELECT strftime(l_shipdate, '%m%d%H%M') AS date,
               CAST(date_diff('day', o_orderdate, l_shipdate) AS INT) AS delay,
               CAST(floor(l_extendedprice / 10) AS INT) AS distance,
               sn.n_name AS origin, cn.n_name AS destination
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN nation cn ON c_nationkey = cn.n_nationkey""",
    "v_airports": """
        SELECT n_name AS IATA, n_name AS City, r_name AS State
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_flight_summary": """
        SELECT destination AS DEST_COUNTRY_NAME, origin AS ORIGIN_COUNTRY_NAME, count(*) AS "count"
        FROM v_flights GROUP BY destination, origin""",
    "v_usage": """
        SELECT c_custkey AS uid, c_name AS uname, CAST((c_custkey * 7919) % 1000 AS INT) AS usage FROM customer""",
    "v_people": """
        SELECT c_custkey AS id,
               CASE c_custkey % 5 WHEN 0 THEN 'Nell' WHEN 1 THEN 'Dana' WHEN 2 THEN 'Dora' WHEN 3 THEN 'Ana'
                    ELSE 'Eve' END AS firstName,
               c_mktsegment AS middleName,
               CASE c_custkey % 3 WHEN 0 THEN 'Jones' WHEN 1 THEN 'James' ELSE 'Smith' END AS lastName,
               CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender,
               concat(c_custkey % 60 + 1950, '-06-15') AS birthDate,
               concat('900-', c_custkey % 10000) AS ssn,
               CAST((c_custkey * 977) % 150000 AS VARCHAR) AS salary
        FROM customer""",
    "v_employees": "SELECT c_custkey AS emp_no, c_name AS name FROM customer",
    "v_salaries": """
        SELECT o_custkey AS emp_no, o_orderkey AS id, o_orderdate AS to_date, o_totalprice AS salary FROM orders""",
    "v_titles": """
        SELECT o_custkey AS emp_no, o_orderkey AS id, o_orderdate AS to_date, o_orderpriority AS title FROM orders""",
    "v_dept_emp": """
        SELECT o_custkey AS emp_no, o_orderkey AS id, o_orderdate AS to_date, o_orderstatus AS dept_no FROM orders""",
    "v_last_salary": """
        SELECT emp_no, salary AS last_salary FROM v_salaries
        QUALIFY row_number() OVER (PARTITION BY emp_no ORDER BY to_date DESC, id DESC) = 1""",
    "v_last_title": """
        SELECT emp_no, title AS last_title FROM v_titles
        QUALIFY row_number() OVER (PARTITION BY emp_no ORDER BY to_date DESC, id DESC) = 1""",
    "v_last_dept": """
        SELECT emp_no, dept_no AS last_dept FROM v_dept_emp
        QUALIFY row_number() OVER (PARTITION BY emp_no ORDER BY to_date DESC, id DESC) = 1""",
    "v_grouped": "SELECT l_suppkey AS id, l_quantity AS v FROM lineitem",
    "v_arrays": """
        SELECT o_orderkey AS id, list_transform([1, 2, 3], lambda i: CAST(o_orderkey % 10 + i AS INT)) AS "values"
        FROM orders""",
    "v_temps": """
        SELECT event_id AS id,
               list_transform(CASE WHEN event_id % 2 = 0 THEN [0, 1, 2, 3, 4, 5, 6] ELSE [0, 1, 2, 3, 4] END,
                              lambda i: CAST((event_id * 7 + 13 * i) % 31 + 29 AS INT)) AS celsius
        FROM events""",
    "v_squares": "SELECT event_id AS id, (event_id % 10000) * (event_id % 10000) AS square FROM events",
    "v_text": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "v_log": """
        SELECT CASE WHEN event_id % 97 = 0 THEN concat('garbage ', event_id) ELSE
               concat('host', user_id, '.example.com - - [', strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' -0400] "',
                      CASE WHEN event_type = 'error' THEN 'POST' WHEN event_id % 13 = 1 THEN 'HEAD'
                           WHEN event_id % 13 = 2 THEN 'PUT' ELSE 'GET' END, ' /', event_type, '/', event_id % 50, ' ',
                      CASE event_id % 11 WHEN 1 THEN 'HTTP/1.1' WHEN 2 THEN 'HTTP/V1.0' WHEN 3 THEN 'STS-69</a><p>'
                           ELSE 'HTTP/1.0' END, '" ',
                      CASE WHEN event_type = 'error' THEN '404' WHEN event_id % 17 = 1 THEN '304'
                           WHEN event_id % 17 = 2 THEN '302' WHEN event_id % 17 = 3 THEN '500' ELSE '200' END, ' ',
                      CASE WHEN event_id % 10 = 0 THEN '-'
                           ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END) END AS value
        FROM events""",
    "v_log_fields": f"""
        SELECT regexp_extract(value, '{LOG_LINE}',
                              ['host', 'user_identifier', 'user_id', 'stamp', 'request_method', 'resource',
                               'protocol', 'http_status', 'content_size']) AS f
        FROM v_log WHERE regexp_matches(value, '{LOG_LINE}')""",
    "v_requests": """
        SELECT f.host AS host, f.user_identifier AS user_identifier, f.user_id AS user_id,
               CAST(strptime(f.stamp, '%d/%b/%Y:%H:%M:%S') AS TIMESTAMP) AS datetime,
               f.request_method AS request_method, f.resource AS resource, f.protocol AS protocol,
               CAST(f.http_status AS INT) AS http_status,
               CASE f.content_size WHEN '-' THEN 0::BIGINT ELSE TRY_CAST(f.content_size AS BIGINT) END AS content_size
        FROM v_log_fields""",
}
