"""Web-server logs: from lines of text to typed requests, and nine questions about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.functions.clock import parse_log_stamp, part
from sparkwell.functions.patterns import LOG_DATE, LOG_FIELDS, LOG_HOST, LOG_LINE, NO_MATCH
from sparkwell.registry import query


def requests(lines: DataFrame) -> DataFrame:
    """Lines that fit the log format, as nine typed columns; all others are dropped.

    One replacement brings the nine captured fields to single-blank separation. No field can
    hold a blank, so a split then yields exactly the fields. A line that does not fit stays as
    it is, and one that fits never does, since it loses its brackets and quotes. So the pattern
    runs once a line, where testing and extracting each field would run it ten times; exploding
    one element keeps Spark from running it again for the filter. Times stay local: the offset
    is not applied.
    """
    blanks = " ".join(f"${i}" for i in range(1, len(LOG_FIELDS) + 1))
    replaced = F.regexp_replace(F.rtrim(F.col("value"), F.lit("\r")), LOG_LINE, blanks)
    named = (
        lines.select("value", F.explode(F.array(replaced)).alias("parts"))
        .filter(F.col("parts") != F.rtrim(F.col("value"), F.lit("\r")))
        .select(F.split("parts", " ").alias("f"))
        .select(*[F.get("f", F.lit(i)).alias(name) for i, name in enumerate(LOG_FIELDS)])
    )
    size = F.when(F.col("content_size") == "-", F.lit(0).cast("long")).otherwise(F.col("content_size").try_cast("long"))
    return named.withColumns(
        {
            "datetime": parse_log_stamp(F.col("datetime")),
            "http_status": F.col("http_status").cast("int"),
            "content_size": size,
        }
    )


def first_match(text: Column, pattern: str) -> Column:
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found == "", NO_MATCH).otherwise(found)


def host_and_date(lines: DataFrame) -> DataFrame:
    """The host and the time of each line, looked for separately."""
    stamp = first_match(F.col("value"), LOG_DATE)
    found = parse_log_stamp(stamp)
    day = F.concat_ws("/", part(found, "dd"), part(found, "MM"), part(found, "yyyy"))
    time = F.concat_ws(":", part(found, "HH"), part(found, "mm"), part(found, "ss"))
    moment = F.when(found.isNotNull(), F.concat_ws(" ", day, time))
    return lines.select(
        first_match(F.col("value"), LOG_HOST).alias("host"), F.coalesce(moment, F.lit(NO_MATCH)).alias("date")
    )


def frequency(requests: DataFrame, field: Column, name: str, total: str, top: int | None = None) -> DataFrame:
    """How often each value occurs, most frequent first; equal counts are ordered by value."""
    counted = requests.groupBy(field.alias(name)).agg(F.count(field).alias(total)).orderBy(F.desc(total), name)
    return counted if top is None else counted.limit(top)


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests(views.log_lines(spark, sf_dir))


@query("nasa_parse", "SELECT * FROM v_requests")
def nasa_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir)


@query(
    "nasa_subpatterns",
    r"""SELECT CASE h WHEN '' THEN 'no match' ELSE h END AS host,
               CASE d WHEN '' THEN 'no match' ELSE strftime(strptime(d, '%d/%b/%Y:%H:%M:%S'), '%d/%m/%Y %H:%M:%S') END
               AS date
        FROM (SELECT regexp_extract(value, '^(\S+\.\S\S+)\s', 1) AS h,
                     regexp_extract(value, '(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2})', 1) AS d FROM v_log)""",
)
def nasa_subpatterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_and_date(views.log_lines(spark, sf_dir))


@query("nasa_q1", "SELECT DISTINCT protocol FROM v_requests")
def nasa_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).select("protocol").distinct()


@query("nasa_q2", "SELECT http_status, count(*) AS total FROM v_requests GROUP BY http_status")
def nasa_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency(parsed(spark, sf_dir), F.col("http_status"), "http_status", "total")


@query("nasa_q3", "SELECT request_method, count(*) AS total FROM v_requests GROUP BY request_method")
def nasa_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency(parsed(spark, sf_dir), F.col("request_method"), "request_method", "total")


@query(
    "nasa_q4",
    "SELECT resource, content_size FROM v_requests ORDER BY content_size DESC NULLS LAST, resource LIMIT 1",
)
def nasa_q4(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = parsed(spark, sf_dir).select("resource", "content_size")
    return sizes.orderBy(F.desc_nulls_last("content_size"), "resource").limit(1)


@query(
    "nasa_q5",
    "SELECT resource, count(*) AS total FROM v_requests GROUP BY resource ORDER BY total DESC, resource LIMIT 1",
)
def nasa_q5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency(parsed(spark, sf_dir), F.col("resource"), "resource", "total", top=1)


@query(
    "nasa_q6",
    """SELECT CAST(date_trunc('day', datetime) AS TIMESTAMP) AS day, count(*) AS total FROM v_requests GROUP BY ALL
       ORDER BY total DESC, day LIMIT 5""",
)
def nasa_q6(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "datetime").cast("timestamp_ntz")
    return frequency(parsed(spark, sf_dir), day, "day", "total", top=5)


@query("nasa_q7", "SELECT host, count(*) AS total FROM v_requests GROUP BY host ORDER BY total DESC, host LIMIT 5")
def nasa_q7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency(parsed(spark, sf_dir), F.col("host"), "host", "total", top=5)


@query(
    "nasa_q8",
    """SELECT CAST(hour(datetime) AS INT) AS hour, count(*) AS total FROM v_requests GROUP BY ALL
       ORDER BY total DESC, hour LIMIT 5""",
)
def nasa_q8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency(parsed(spark, sf_dir), F.hour("datetime"), "hour", "total", top=5)


@query(
    "nasa_q9",
    """SELECT strftime(datetime, '%Y-%m-%d') AS day, http_status, count(*) AS total FROM v_requests
       WHERE http_status = 404 GROUP BY ALL""",
)
def nasa_q9(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = parsed(spark, sf_dir).filter(F.col("http_status") == 404)
    per_day = missing.groupBy(F.date_format(F.col("datetime").cast("date"), "yyyy-MM-dd").alias("day"), "http_status")
    return per_day.agg(F.count("*").alias("total")).orderBy(F.desc("total"), "day")
