"""Physical layout: partition counts, bucketed tables and caching."""

from __future__ import annotations

import heapq
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwell import skew, storage, views
from sparkwell.registry import query
from sparkwell.session import shuffle_partitions
from sparkwell.studies.weblogs import requests
from sparkwell.tables import table


def save_bucketed(rows: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """A Parquet table hashed and sorted by ``keys``.

    The repartition hashes as the bucketing does, so a task holds one bucket and writes one file.
    """
    placed = rows.repartition(buckets, *keys)
    placed.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(name)


def bucketed_pair(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    many: Callable[[], DataFrame],
    many_key: str,
    spread_by: str,
    one: Callable[[], DataFrame],
    one_key: str,
    buckets: int | None = None,
    share: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Two tables bucketed alike on (key, salt), so that joining on both needs no shuffle.

    A key with more rows than a bucket should hold gets as many salts as it fills buckets; on the
    other side only such keys are repeated. ``label`` names the two inputs: the tables are
    made once for each label, table folder and layout.
    """
    count = buckets or max(8, shuffle_partitions(spark))

    def make() -> str:
        database = storage.new_database(spark)
        hot = skew.hot_keys(many(), many_key, share if share is not None else 1.0 / count)
        salted = skew.salt_many(many(), many_key, [spread_by], hot)
        repeated = skew.salt_one(one(), one_key, hot)
        save_bucketed(salted, f"{database}.many", [many_key, "salt"], count)
        save_bucketed(repeated, f"{database}.one", [one_key, "salt"], count)
        return database

    database = storage.once(spark, f"bucketed-{label}-{many_key}-{one_key}-{spread_by}-{count}-{share}", sf_dir, make)
    return spark.table(f"{database}.many"), spark.table(f"{database}.one")


def rows_per_partition(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))


#: Slots for each partition that keys below the fair share are hashed into before they are packed.
SLOTS = 16


def placed_by_key(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """``rows``, whole, over ``parts`` partitions: all rows of a key in one, unless it holds more than a partition's fair share.

    Such a key is cut into pieces of a fair share. Larger keys count for themselves, all others by slots of their
    hash; pieces, keys and slots are packed, the largest first, each into the partition that is emptiest so far.
    A partition then holds less than two fair shares. The driver sees as many numbers as
    there are slots; null is a key like any other.
    """
    spark, slots = rows.sparkSession, SLOTS * parts
    slot = F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")
    per_key = storage.written(rows.groupBy(key).agg(F.count("*").alias("n")), "rows-by-key")
    fair = -(-(per_key.agg(F.sum("n")).first()[0] or 0) // parts)
    large = [(r[key], r["n"]) for r in per_key.filter(F.col("n") > fair / 4).collect()]
    small = {r["slot"]: r["n"] for r in per_key.filter(F.col("n") <= fair / 4).groupBy(slot.alias("slot")).agg(F.sum("n").alias("n")).collect()}
    pieces = {i: -(-n // fair) for i, (_, n) in enumerate(large)}
    items = [(large[i][1] / count, ("key", i, piece)) for i, count in pieces.items() for piece in range(count)]
    items += [(n, ("slot", s, 0)) for s, n in small.items()]
    load, home = [(0.0, p) for p in range(parts)], {}
    for n, item in sorted(items, key=lambda x: (-x[0], x[1])):
        filled, part = heapq.heappop(load)
        home[item] = part
        heapq.heappush(load, (filled + n, part))
    kind = rows.schema[key].dataType
    of_keys = T.StructType([T.StructField("large_key", kind)]).add("piece", "integer").add("pieces", "integer").add("place", "integer")
    keys = spark.createDataFrame([(large[i][0], p, pieces[i], part) for (what, i, p), part in home.items() if what == "key"], of_keys)
    others = spark.createDataFrame([(s, part) for (what, s, _), part in home.items() if what == "slot"], "small_slot int, place_of_slot int")
    counts = keys.groupBy("large_key").agg(F.first("pieces").alias("pieces_of_key")).withColumnRenamed("large_key", "counted_key")
    numbered = rows.withColumn("row_number_in_scan", F.monotonically_increasing_id())
    cut = numbered.join(F.broadcast(counts), F.col(key).eqNullSafe(F.col("counted_key")), "left")
    cut = cut.withColumn("row_piece", F.pmod(F.xxhash64("row_number_in_scan"), F.coalesce("pieces_of_key", F.lit(1))).cast("int"))
    cut = cut.join(F.broadcast(keys.drop("pieces")), F.col(key).eqNullSafe(F.col("large_key")) & (F.col("row_piece") == F.col("piece")), "left")
    cut = cut.join(F.broadcast(others), slot == F.col("small_slot"), "left")
    place = F.coalesce("place", "place_of_slot")
    return cut.withColumn("place", place).repartitionById(parts, F.col("place")).select(*rows.columns)


def from_disk_cache(rows: DataFrame, reports: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """Answer several questions from one disk-only cached result, then let the cache go.

    The answers are written before the cache is dropped; a lost executor only means that its
    cached blocks are computed again.
    """
    held = rows.persist(StorageLevel.DISK_ONLY)
    try:
        reports(held).write.parquet(path)
    finally:
        held.unpersist()
    return rows.sparkSession.read.parquet(path)


@query("layout_repartition", "SELECT true AS all_used, count(*) AS n FROM lineitem")
def layout_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = max(16, shuffle_partitions(spark))
    spread = table(spark, sf_dir, "lineitem").select("l_orderkey").repartition(wanted)
    used = F.count("part") == F.lit(wanted)
    return rows_per_partition(spread).agg(used.alias("all_used"), F.sum("n").alias("n"))


@query(
    "layout_repartition_by_key",
    "SELECT l_returnflag, CAST(1 AS BIGINT) AS parts, count(*) AS n FROM lineitem GROUP BY l_returnflag",
)
def layout_repartition_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rows of one flag are few after counting by flag and input partition, so moving them
    # by flag moves counts and not lines.
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag")
    counted = lines.groupBy("l_returnflag", F.spark_partition_id().alias("source")).agg(F.count("*").alias("n"))
    placed = counted.repartition(16, "l_returnflag").withColumn("part", F.spark_partition_id())
    return placed.groupBy("l_returnflag").agg(F.countDistinct("part").alias("parts"), F.sum("n").alias("n"))


@query(
    "layout_rows_by_key",
    """SELECT count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS line_numbers, count(DISTINCT l_suppkey) AS keys, true AS balanced,
              CAST(0 AS BIGINT) AS torn_keys
       FROM lineitem""",
)
def layout_rows_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole lines laid out by supplier, a file a partition, and what the layout is like."""
    parts = max(16, shuffle_partitions(spark))

    def write(path: str) -> None:
        lines = placed_by_key(table(spark, sf_dir, "lineitem"), "l_suppkey", parts)
        lines.withColumn("part", F.spark_partition_id()).write.parquet(path)

    lines = spark.read.parquet(storage.staged(spark, f"lines-by-supplier-{parts}", sf_dir, write))
    each = lines.groupBy("l_suppkey", "part").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("line_numbers"))
    of_part = each.groupBy("part").agg(F.sum("n").alias("n"))
    of_key = each.groupBy("l_suppkey").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("line_numbers").alias("line_numbers"))
    most, fair = of_part.agg(F.max("n"), F.ceil(F.sum("n") / parts)).first()
    return of_key.agg(
        F.sum("n").alias("n"),
        F.sum("line_numbers").alias("line_numbers"),
        F.count("*").alias("keys"),
        F.lit(most is None or most < 2 * fair).alias("balanced"),
        # A key lies in as many partitions as it fills, one if it is below the fair share.
        F.count_if(F.col("parts") > F.ceil(F.col("n") / fair)).alias("torn_keys"),
    )


@query(
    "cache_disk_only",
    """SELECT 'protocol' AS field, protocol AS value, count(*) AS n FROM v_requests GROUP BY protocol UNION ALL
       SELECT 'method', request_method, count(*) FROM v_requests GROUP BY request_method""",
)
def cache_disk_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    def both(parsed: DataFrame) -> DataFrame:
        by_protocol = parsed.groupBy(F.lit("protocol").alias("field"), F.col("protocol").alias("value"))
        by_method = parsed.groupBy(F.lit("method").alias("field"), F.col("request_method").alias("value"))
        return by_protocol.agg(F.count("*").alias("n")).union(by_method.agg(F.count("*").alias("n")))

    parsed = requests(views.log_lines(spark, sf_dir))
    return from_disk_cache(parsed, both, storage.new_path(spark, "cached"))
