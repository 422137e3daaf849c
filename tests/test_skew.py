"""One key holds a third of the rows: results stay whole and the work is spread."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from sparkwell import skew
from sparkwell.functions.udfs import subtract_mean, subtract_mean_in_lists, subtract_mean_in_pandas
from sparkwell.operators.joins import full_outer
from sparkwell.operators.scans import running
from sparkwell.plans.layout import bucketed_pair, placed_by_key

N = 9000


@pytest.fixture
def lopsided(spark):
    """Key 7 has a third of the rows, the rest are spread over 50 keys."""
    key = F.when(F.col("row") % 3 == 0, F.lit(7)).otherwise(F.col("row") % 50 + 100)
    rows = spark.range(N, numPartitions=6).withColumnRenamed("id", "row")
    return rows.select("row", key.cast("long").alias("id"), (F.col("row") % 11).cast("double").alias("v"))


def test_hot_keys_are_few_and_exact(lopsided):
    assert skew.hot_keys(lopsided, "id", share=0.1) == [(7, 4)]
    assert skew.hot_keys(lopsided, "id", share=0.5) == []
    assert len(skew.hot_keys(lopsided, "id", share=0.0)) == 51
    assert sum(salts for _, salts in skew.hot_keys(lopsided, "id", share=0.01)) < 200


def test_salts_follow_the_rows_of_a_key(spark):
    """Four hot keys of 64 buckets don't repeat the other side 64 times each."""
    rows = spark.range(10_000).selectExpr("CASE WHEN id % 10 < 8 THEN id % 4 ELSE id END AS k", "id AS row")
    hot = skew.hot_keys(rows, "k", share=1 / 64)
    one = skew.salt_one(spark.range(100).withColumnRenamed("id", "k"), "k", hot)
    assert one.count() <= 100 + 2 * 64
    assert skew.salt_many(rows, "k", ["row"], hot).select("k", "salt").filter("k < 4").distinct().count() == sum(n for _, n in hot)


def test_hot_rows_are_salted_in_one_join(spark, lopsided, no_broadcast, tmp_path):
    lopsided.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    per_key = rows.groupBy("id").agg(F.sum("v").alias("total"))
    joined = skew.attach_per_key(rows, per_key, "id", share=0.1)
    assert rows_of(joined.select("row", "id", "total")) == rows_of(rows.join(per_key, "id").select("row", "id", "total"))
    plan = plan_of(joined)
    assert plan.count("SortMergeJoin") == 1 and plan.count("FileScan") == 2 and "salt" in plan


def test_without_hot_keys_the_join_is_plain(lopsided, no_broadcast):
    per_key = lopsided.groupBy("id").agg(F.sum("v").alias("total"))
    plan = plan_of(skew.attach_per_key(lopsided, per_key, "id", share=0.9))
    assert "Union" not in plan and plan.count("SortMergeJoin") == 1


@pytest.mark.parametrize("share", [0.9, 0.1, 0.0])
def test_rows_without_a_key_are_a_group_of_their_own(lopsided, share):
    some_null = lopsided.select(F.when(F.col("id") != 7, F.col("id")).alias("id"), "v")
    mean = some_null.filter("id IS NULL").agg(F.avg("v")).first()[0]
    for way in (subtract_mean, subtract_mean_in_pandas):
        found = way(some_null, share)
        assert found.count() == N, way.__name__
        lost = found.filter("id IS NULL")
        assert lost.count() == N // 3 and abs(lost.agg(F.max("v")).first()[0] - (10 - mean)) < 1e-9


def test_an_inner_join_drops_rows_without_a_key(lopsided):
    some_null = lopsided.select(F.when(F.col("id") != 7, F.col("id")).alias("id"), "v")
    per_key = some_null.groupBy("id").agg(F.count("*").alias("n"))
    for share in (0.9, 0.1):
        assert skew.attach_per_key(some_null, per_key, "id", share).count() == N - N // 3


@pytest.mark.parametrize("share", [0.9, 0.1, 0.0])
def test_subtract_mean_is_the_same_however_groups_are_cut(lopsided, share):
    pdf = lopsided.toPandas()
    expected = sorted(zip(pdf.id, (pdf.v - pdf.groupby("id").v.transform("mean")).round(9)))
    rows = lopsided.select("id", "v")
    for way in (subtract_mean, subtract_mean_in_pandas):
        found = way(rows, share).toPandas()
        assert sorted(zip(found.id, found.v.round(9))) == expected, way.__name__


def test_a_hot_group_reaches_pandas_in_pieces(lopsided):
    rows = lopsided.select("id", "v")
    few, many = (subtract_mean_in_pandas(rows, share) for share in (1.0, 0.01))
    assert rows_of(few) == rows_of(many)


def test_rows_are_shuffled_once_for_pandas(lopsided, no_broadcast):
    """By (id, piece), for the join and for pandas; the other exchange is of means."""
    plan = plan_of(subtract_mean_in_pandas(lopsided.select("id", "v")))
    above = plan[: plan.index("ShuffledHashJoin")]
    below = plan[plan.index("ShuffledHashJoin") :]
    assert "Exchange" not in above and below.count("Exchange hashpartitioning(known_id") == 2


@pytest.mark.parametrize("share", [0.9, 0.01])
def test_nan_and_null_are_the_same_everywhere(spark, share):
    values = [(1, 1.0), (1, float("nan")), (1, 3.0), (2, 1.0), (2, None), (2, 3.0), (None, 5.0), (None, 7.0)]
    rows = spark.createDataFrame(values, "id long, v double")
    wanted = sorted(map(str, [(1, float("nan"))] * 3 + [(2, -1.0), (2, None), (2, 1.0), (None, -1.0), (None, 1.0)]))
    assert sorted(str(tuple(r)) for r in subtract_mean(rows, share).collect()) == wanted
    assert sorted(str(tuple(r)) for r in subtract_mean_in_pandas(rows, share).collect()) == wanted
    for most in (1, 2, 1000):
        assert sorted(str(tuple(r)) for r in subtract_mean_in_lists(rows, most, share).collect()) == wanted


def test_lists_of_a_hot_group_are_bounded(lopsided):
    rows = lopsided.select("id", "v")
    found = subtract_mean_in_lists(rows, most=50, share=0.05)
    assert sorted((r.id, round(r.v, 9)) for r in found.collect()) == sorted((r.id, round(r.v, 9)) for r in subtract_mean(rows).collect())
    numbered = rows.select("id", "v", F.monotonically_increasing_id().alias("row"))
    sizes = running(numbered, "id", ("row",), {"nth": ("count", "row")}, 0.05).groupBy("id", F.expr("(nth - 1) div 50")).count()
    assert sizes.agg(F.max("count")).first()[0] == 50


@pytest.mark.parametrize("parts", [1, 7, 32])
def test_rows_placed_by_key_are_balanced_and_whole(spark, parts):
    """One key with a third, one with a tenth of the rows, many small ones, a null key, repeated rows."""
    rows = spark.range(20_000).selectExpr("case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else concat('k', id % 700) end as k", "id % 50 as x", "concat('text', id % 9) as t")
    placed = placed_by_key(rows, "k", parts)
    assert placed.columns == rows.columns and placed.exceptAll(rows).count() == 0 and rows.exceptAll(placed).count() == 0
    each = placed.withColumn("p", F.spark_partition_id()).groupBy("k", "p").count().collect()
    per_part, homes, size = {}, {}, {}
    for r in each:
        per_part[r.p] = per_part.get(r.p, 0) + r["count"]
        homes[r.k] = homes.get(r.k, 0) + 1
        size[r.k] = size.get(r.k, 0) + r["count"]
    fair = -(-20_000 // parts)
    assert max(per_part.values()) < 2 * fair and len(per_part) == parts
    assert all(homes[k] <= -(-n // fair) for k, n in size.items())


def test_nothing_is_placed_nowhere(spark):
    assert placed_by_key(spark.createDataFrame([], "k string, x int"), "k", 8).collect() == []


def test_salted_buckets_spread_a_hot_key_and_lose_nothing(spark, lopsided):
    names = spark.range(200).select(F.col("id").alias("uid"), F.concat(F.lit("n"), "id").alias("name"))
    many, one = bucketed_pair(
        spark, "lopsided", "lopsided", many=lambda: lopsided, many_key="id", spread_by="row", one=lambda: names, one_key="uid",
        buckets=8, share=0.1,
    )
    assert many.filter("id = 7").select("salt").distinct().count() == 4
    assert many.filter("id <> 7").select("salt").distinct().count() == 1
    assert one.filter("uid = 7").count() == 4 and one.count() == 203
    joined = many.join(one.hint("merge"), (many["id"] == one["uid"]) & (many["salt"] == one["salt"]))
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    plain = lopsided.join(names, F.col("id") == F.col("uid"))
    assert rows_of(joined.select("row", "name")) == rows_of(plain.select("row", "name"))


def test_full_outer_join_keeps_all_rows_of_both_sides(spark, lopsided):
    few = spark.createDataFrame([(7, "hot"), (101, "warm"), (999, "alone")], "id LONG, name STRING")
    many = lopsided.select("id", "row").union(spark.createDataFrame([(None, -1)], "id LONG, row LONG"))
    found = full_outer(many, few, "id").select("id", "row", "name")
    assert rows_of(found) == rows_of(many.join(few, "id", "full").select("id", "row", "name"))


def test_size_check_decides_about_a_broadcast(spark):
    big = spark.range(1000)
    assert skew.at_most(big, 1000) and not skew.at_most(big, 999)
    other = spark.range(10**6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(other.join(skew.broadcast_if_small(big, 1000), "id"))
        assert "SortMergeJoin" in plan_of(other.join(skew.broadcast_if_small(big, 999), "id"))
        wide = big.withColumn("text", F.repeat(F.lit("x"), 1000)).withColumn("list", F.array("id"))
        assert 1_000_000 < skew.bytes_of(wide) < 1_100_000
        assert "SortMergeJoin" in plan_of(other.join(skew.broadcast_if_small(wide, 1000, max_bytes=10**6), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_adaptive_execution_splits_a_skewed_join(spark, lopsided, tmp_path):
    lopsided.write.parquet(str(tmp_path / "rows"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.read.parquet(str(tmp_path / "rows")).repartition(8)
        names = spark.range(200).select("id", F.concat(F.lit("n"), F.col("id")).alias("name"))
        joined = rows.join(names, "id")
        assert joined.count() == joined.select("row").distinct().count() == N
        joined.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_bucketed_tables_are_kept_by_label(spark):
    def pair(label, n):
        many = spark.range(n).selectExpr("id % 5 AS k", "id AS row")
        one = spark.range(5).withColumnRenamed("id", "k")
        return bucketed_pair(spark, "none", label, many=lambda: many, many_key="k", spread_by="row", one=lambda: one, one_key="k", buckets=4)

    assert pair("ten", 10)[0].count() == 10 and pair("many", 500)[0].count() == 500 and pair("ten", 500)[0].count() == 10
