"""One query for each source: the given tables are written in the source's format, then read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwell import storage, views
from sparkwell.registry import query
from sparkwell.sources import readers
from sparkwell.tables import table

# The columns of the file of emergency calls, in order. Numbers that grow with the data are long.
CALLS = (
    T.StructType()
    .add("CallNumber", T.LongType())
    .add("UnitID", T.StringType())
    .add("IncidentNumber", T.LongType())
    .add("CallType", T.StringType())
    .add("CallDate", T.StringType())
    .add("WatchDate", T.StringType())
    .add("CallFinalDisposition", T.StringType())
    .add("AvailableDtTm", T.StringType())
    .add("Address", T.StringType())
    .add("City", T.StringType())
    .add("Zipcode", T.IntegerType())
    .add("Battalion", T.StringType())
    .add("StationArea", T.StringType())
    .add("Box", T.StringType())
    .add("OriginalPriority", T.StringType())
    .add("Priority", T.StringType())
    .add("FinalPriority", T.IntegerType())
    .add("ALSUnit", T.BooleanType())
    .add("CallTypeGroup", T.StringType())
    .add("NumAlarms", T.IntegerType())
    .add("UnitType", T.StringType())
    .add("UnitSequenceInCallDispatch", T.IntegerType())
    .add("FirePreventionDistrict", T.StringType())
    .add("SupervisorDistrict", T.StringType())
    .add("Neighborhood", T.StringType())
    .add("Location", T.StringType())
    .add("RowID", T.StringType())
    .add("Delay", T.FloatType())
)
FLIGHTS = "date STRING, delay INT, distance INT, origin STRING, destination STRING"
PEOPLE = (
    "id LONG, firstName STRING, middleName STRING, lastName STRING, gender STRING, birthDate STRING, "
    "ssn STRING, salary STRING"
)
BLOGS = (
    T.StructType()
    .add("Id", T.LongType())
    .add("First", T.StringType())
    .add("Last", T.StringType())
    .add("Url", T.StringType())
    .add("Published", T.StringType())
    .add("Hits", T.LongType())
    .add("Campaigns", T.ArrayType(T.StringType()))
)

_VIEWS = {
    "sales": views.sales,
    "calls": views.call_rows,
    "flights": views.flights,
    "people": views.people,
    "blogs": views.blogs,
    "iot": views.iot,
    "summary": views.flight_summary,
}


def csv_copy(spark: SparkSession, sf_dir: str, name: str, sep: str = ",", codec: str = "none") -> str:
    def write(path: str) -> None:
        rows = _VIEWS[name](spark, sf_dir)
        rows.write.option("header", True).option("sep", sep).option("compression", codec).csv(path)

    return storage.staged(spark, f"{name}-csv-{sep.encode().hex()}-{codec}", sf_dir, write)


def copy_as(spark: SparkSession, sf_dir: str, name: str, fmt: str) -> str:
    def write(path: str) -> None:
        _VIEWS[name](spark, sf_dir).write.format(fmt).save(path)

    return storage.staged(spark, f"{name}-{fmt}", sf_dir, write)


@query("src_text_lines", "SELECT value FROM v_text")
def src_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        views.text_lines(spark, sf_dir).write.option("lineSep", "\n").text(path)

    return readers.read_text(spark, storage.staged(spark, "text", sf_dir, write))


@query("src_text_gzip", "SELECT value FROM v_log")
def src_text_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        views.log_lines(spark, sf_dir).write.option("compression", "gzip").text(path)

    return readers.read_gzip_text(spark, storage.staged(spark, "log-gz", sf_dir, write))


@query("src_csv_infer", 'SELECT State, Color, "Count" FROM v_sales')
def src_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_csv(spark, csv_copy(spark, sf_dir, "sales"))


@query("src_csv_struct", "SELECT * FROM v_call_rows")
def src_csv_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.read_csv(spark, csv_copy(spark, sf_dir, "calls"), CALLS)
    return rows.withColumn("Delay", F.col("Delay").cast("double"))


@query("src_csv_ddl", "SELECT * FROM v_flights")
def src_csv_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_csv(spark, csv_copy(spark, sf_dir, "flights"), FLIGHTS)


@query("src_csv_failfast", "SELECT CallNumber, CallType, Zipcode, ALSUnit, Delay FROM v_call_rows")
def src_csv_failfast(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict = readers.read_csv(spark, csv_copy(spark, sf_dir, "calls"), CALLS, strict=True)
    return strict.select("CallNumber", "CallType", "Zipcode", "ALSUnit", F.col("Delay").cast("double").alias("Delay"))


@query("src_csv_sep", "SELECT 'colon' AS sep, * FROM v_people UNION ALL SELECT 'tab', * FROM v_people")
def src_csv_sep(spark: SparkSession, sf_dir: str) -> DataFrame:
    colon = readers.read_csv(spark, csv_copy(spark, sf_dir, "people", sep=":"), PEOPLE, sep=":")
    tab = readers.read_csv(spark, csv_copy(spark, sf_dir, "people", sep="\t"), PEOPLE, sep="\t")
    return colon.select(F.lit("colon").alias("sep"), "*").union(tab.select(F.lit("tab").alias("sep"), "*"))


def _compressed(spark: SparkSession, sf_dir: str, codec: str) -> DataFrame:
    return readers.read_csv(spark, csv_copy(spark, sf_dir, "people", sep=":", codec=codec), PEOPLE, sep=":")


@query("src_csv_gzip", "SELECT * FROM v_people")
def src_csv_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compressed(spark, sf_dir, "gzip")


@query("src_csv_bzip2", "SELECT * FROM v_people")
def src_csv_bzip2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compressed(spark, sf_dir, "bzip2")


@query("src_csv_snappy", "SELECT * FROM v_people")
def src_csv_snappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compressed(spark, sf_dir, "snappy")


@query("src_schema_json", 'SELECT State, Color, "Count" FROM v_sales')
def src_schema_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = csv_copy(spark, sf_dir, "sales")

    def infer_once(path: str) -> None:
        readers.save_schema(spark, readers.read_csv(spark, data).schema, path)

    kept = storage.staged(spark, "sales-schema", sf_dir, infer_once)
    return readers.read_csv(spark, data, readers.load_schema(spark, kept))


@query(
    "src_json_schema",
    """SELECT Id, "First", "Last", Url, Published, Hits, array_to_string(Campaigns, ',') AS Campaigns FROM v_blogs""",
)
def src_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    authors = readers.read_json(spark, copy_as(spark, sf_dir, "blogs", "json"), BLOGS)
    return authors.withColumn("Campaigns", F.array_join("Campaigns", ","))


@query("src_json_infer", "SELECT * FROM v_iot")
def src_json_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_json(spark, copy_as(spark, sf_dir, "iot", "json"))


@query("src_parquet", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished = readers.read_as(spark, "parquet", f"{sf_dir}/orders.parquet").filter("o_orderstatus = 'F'")
    return finished.select("o_orderkey", "o_totalprice")


@query("src_orc", "SELECT * FROM v_flight_summary")
def src_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_as(spark, "orc", copy_as(spark, sf_dir, "summary", "orc"))


@query("src_glob", "SELECT * FROM v_flight_summary")
def src_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = copy_as(spark, sf_dir, "summary", "json")
    schema = "DEST_COUNTRY_NAME STRING, ORIGIN_COUNTRY_NAME STRING, count LONG"
    return readers.read_json(spark, f"{folder}/part-*", schema)


@query(
    "src_view_using",
    """SELECT f.format AS format, s.DEST_COUNTRY_NAME, s.ORIGIN_COUNTRY_NAME, s."count" FROM v_flight_summary s,
       (SELECT unnest(['parquet', 'orc', 'json', 'csv']) AS format) f""",
)
def src_view_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    picks = []
    for fmt in ("parquet", "orc", "json", "csv"):
        csv = fmt == "csv"
        path = csv_copy(spark, sf_dir, "summary") if csv else copy_as(spark, sf_dir, "summary", fmt)
        name = f"sparkwell_summary_{fmt}"
        readers.view_on_files(spark, name, fmt, path, **({"header": "true", "inferSchema": "true"} if csv else {}))
        picks.append(
            f"SELECT '{fmt}' AS format, DEST_COUNTRY_NAME, ORIGIN_COUNTRY_NAME, CAST(count AS BIGINT) AS count FROM {name}"
        )
    return spark.sql(" UNION ALL ".join(picks))


# What each order priority promises, in days.
PROMISED = [("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 7), ("4-NOT SPECIFIED", 14), ("5-LOW", 30)]


@query(
    "src_literal_rows",
    """SELECT o_orderkey, days FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 3), ('3-MEDIUM', 7),
         ('4-NOT SPECIFIED', 14), ('5-LOW', 30)) AS p(priority, days) ON o_orderpriority = priority""",
)
def src_literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    promised = F.broadcast(spark.createDataFrame(PROMISED, "priority STRING, days INT"))  # five rows
    orders = table(spark, sf_dir, "orders")
    return orders.join(promised, F.col("o_orderpriority") == F.col("priority")).select("o_orderkey", "days")


@query(
    "src_range",
    """SELECT r.id, o_custkey FROM (SELECT unnest(range((SELECT min(o_orderkey) FROM orders), (SELECT max(o_orderkey) + 1 FROM orders))) AS id) r
       LEFT JOIN orders ON o_orderkey = r.id""",
)
def src_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every number between the least and the greatest order key, with the customer of the order that has it."""
    orders = table(spark, sf_dir, "orders")
    least, most = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    ids = spark.range(0) if least is None else spark.range(least, most + 1)
    return ids.join(orders.select(F.col("o_orderkey").alias("id"), "o_custkey"), "id", "left")


def synthetic_usage(seeds: DataFrame, uid: str, seed: str) -> DataFrame:
    """A user with a made-up usage below 1000 for each row. Columns follow from the row's own values, so a retry repeats them."""
    return seeds.select(
        F.col(uid).alias("uid"),
        F.concat(F.lit("user-"), F.lpad(F.col(uid).cast("string"), 12, "0")).alias("uname"),
        F.pmod(F.col(uid) * 7919 + F.col(seed) * 17, F.lit(1000)).cast("int").alias("usage"),
    )


def synthetic_orders(seeds: DataFrame, transaction_id: str, uid: str, seed: Column) -> DataFrame:
    """A made-up order of the row's user for each row, in the same way."""
    return seeds.select(
        F.col(transaction_id).alias("transaction_id"),
        F.col(uid).alias("users_id"),
        (F.pmod(F.col(transaction_id) + seed, F.lit(50)) + 1).cast("int").alias("quantity"),
        (F.pmod(F.col(transaction_id) * 31 + seed, F.lit(10000)) / 4).alias("amount"),
    )


@query(
    "src_synthetic",
    """SELECT uid, uname, usage, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity, round(sum(amount), 4) AS amount
       FROM (SELECT c_custkey AS uid, concat('user-', lpad(CAST(c_custkey AS VARCHAR), 12, '0')) AS uname,
                    CAST((c_custkey * 7919 + c_nationkey * 17) % 1000 AS INT) AS usage FROM customer)
       JOIN (SELECT o_custkey AS users_id, CAST((o_orderkey + dayofyear(o_orderdate)) % 50 + 1 AS INT) AS quantity,
                    (o_orderkey * 31 + dayofyear(o_orderdate)) % 10000 / 4.0::DOUBLE AS amount FROM orders) ON users_id = uid
       GROUP BY ALL""",
)
def src_synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and orders generated from the keys of real ones, so the two fit together as those do."""
    placed = synthetic_orders(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", F.dayofyear("o_orderdate"))
    per_user = placed.groupBy(F.col("users_id").alias("uid")).agg(
        F.count("*").alias("orders"), F.sum("quantity").alias("quantity"), F.round(F.sum("amount"), 4).alias("amount")
    )
    return synthetic_usage(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey").join(per_user, "uid")


PRIORITIES = range(1, 6)


def priority_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each nation and month with orders, how long the bar of each priority is, from 0 to 7."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("int").alias("nation"))
    dated = table(spark, sf_dir, "orders").select(
        "o_custkey",
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
    )
    each = [F.count_if(F.col("priority") == p).alias(f"n{p}") for p in PRIORITIES]
    counted = dated.join(customers, "o_custkey").groupBy("nation", "month").agg(*each)
    most = F.greatest(*[F.col(f"n{p}") for p in PRIORITIES])
    return counted.select("nation", "month", *[F.floor(F.col(f"n{p}") * 7 / most).cast("int").alias(f"bar{p}") for p in PRIORITIES])


def bar_pictures(spark: SparkSession, sf_dir: str) -> str:
    """One 8 x 5 black-and-white bitmap (WBMP) of the priorities' bars for each nation and month: as many files as the orders reach.

    A bitmap is encoded where its counts are, and each task writes the files of its rows. All bytes
    are below 128, so the text writer can write them.
    """

    def write(path: str) -> None:
        lit = [F.char(F.expr(f"shiftleft(1, bar{p}) - 1")) for p in PRIORITIES]
        size = F.lit("\x00\x00\x08\x05")
        pictures = priority_bars(spark, sf_dir).select("nation", "month", F.concat(size, *lit).alias("value"))
        pictures.write.partitionBy("nation", "month").text(path)

    return storage.staged(spark, "pictures", sf_dir, write)


_BARS = """SELECT nation, month, p, CAST(floor(n * 7 / (max(n) OVER (PARTITION BY nation, month))) AS INT) AS bar FROM (
             SELECT CAST(c_nationkey AS INT) AS nation, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS month, p,
                    count(*) FILTER (WHERE CAST(substr(o_orderpriority, 1, 1) AS INT) = p) AS n
             FROM orders JOIN customer ON o_custkey = c_custkey CROSS JOIN (SELECT unnest(range(1, 6)) AS p) GROUP BY ALL)"""


@query(
    "src_image",
    f"""SELECT nation, month, 5::INT AS height, 8::INT AS width, 3::INT AS nChannels, 16::INT AS mode, CAST(sum(bar) AS INT) AS lit
        FROM ({_BARS}) GROUP BY nation, month""",
)
def src_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    pictures = readers.read_images(spark, bar_pictures(spark, sf_dir))
    white = F.length(F.replace(F.hex("image.data"), F.lit("00"), F.lit(""))) / 6
    return pictures.select(
        "nation", "month", "image.height", "image.width", "image.nChannels", "image.mode", white.cast("int").alias("lit")
    )


@query(
    "src_binary",
    f"""SELECT nation, month, 10::BIGINT AS length,
               '00000805' || string_agg(printf('%02X', (1 << bar) - 1), '' ORDER BY p) || '0A' AS content
        FROM ({_BARS}) GROUP BY nation, month""",
)
def src_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = readers.read_binary(spark, bar_pictures(spark, sf_dir), "*.txt", recursive=True)
    part = lambda name: F.regexp_extract("path", rf"{name}=(\d+)", 1).cast("int").alias(name)
    return files.select(part("nation"), part("month"), "length", F.hex("content").alias("content"))


def avro_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_as(spark, "avro", copy_as(spark, sf_dir, "summary", "avro"))
