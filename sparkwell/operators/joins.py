"""Joins.

Two inputs that both come from a scan are joined plainly: adaptive execution splits a
skewed partition of the side that has many rows per key. The other shapes go through
``sparkwell.skew``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import skew, views
from sparkwell.operators.windows import latest
from sparkwell.plans.layout import bucketed_pair
from sparkwell.registry import query
from sparkwell.tables import table

# The order priorities.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def full_outer(many: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """Full outer join where ``many`` may hold most of its rows under one key.

    Spark cannot split a skewed full outer join, but it can split the left side of a left
    join. The rows found only in ``few`` come from an anti join on the distinct keys.
    """
    matched_or_left = many.join(few, key, "left")
    only_few = few.join(many.select(key).distinct(), key, "left_anti")
    return matched_or_left.unionByName(only_few, allowMissingColumns=True)


def pair_with_each(rows: DataFrame, name: str, values: tuple[str, ...]) -> DataFrame:
    """Every row with every one of a fixed list of values; the list is part of the plan."""
    return rows.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("uid"), F.col("c_name").alias("login"), F.col("c_nationkey").alias("user_state")
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("users_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("state"),
    )


_PURCHASES_OF_USERS = """SELECT o_orderkey AS transaction_id, c_custkey AS uid, c_name AS login, o_totalprice AS amount
                         FROM orders JOIN customer ON o_custkey = c_custkey"""
_SHOWN = ("transaction_id", "uid", "login", "amount")


@query("join_sort_merge", _PURCHASES_OF_USERS)
def join_sort_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = users(spark, sf_dir).hint("merge")
    return purchases(spark, sf_dir).join(known, F.col("users_id") == F.col("uid")).select(*_SHOWN)


@query("join_broadcast", _PURCHASES_OF_USERS)
def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = skew.broadcast_if_small(users(spark, sf_dir))
    return purchases(spark, sf_dir).join(known, F.col("users_id") == F.col("uid")).select(*_SHOWN)


@query("join_bucketed", _PURCHASES_OF_USERS)
def join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    many, one = bucketed_pair(
        spark,
        sf_dir,
        "purchases-of-users",
        many=lambda: purchases(spark, sf_dir),
        many_key="users_id",
        spread_by="transaction_id",
        one=lambda: users(spark, sf_dir),
        one_key="uid",
    )
    same = (many["users_id"] == one["uid"]) & (many["salt"] == one["salt"])
    return many.join(one.hint("merge"), same).select(*_SHOWN)


@query(
    "join_inner",
    """SELECT City, State, date, delay, distance, destination FROM v_flights JOIN v_airports ON IATA = origin
       WHERE origin = 'NATION_20' AND destination = 'NATION_7'""",
)
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    route = views.flights(spark, sf_dir).filter("origin = 'NATION_20' AND destination = 'NATION_7'").alias("f")
    airports = views.airports(spark, sf_dir).alias("a")
    met = route.join(airports, F.col("a.IATA") == F.col("f.origin"), "inner")
    return met.select("a.City", "a.State", "f.date", "f.delay", "f.distance", "f.destination")


@query(
    "join_multiway",
    """SELECT s.emp_no, s.id, s.salary, e.name, t.last_title FROM v_salaries s
       JOIN v_employees e ON e.emp_no = s.emp_no JOIN v_last_title t ON t.emp_no = s.emp_no""",
)
def join_multiway(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two of the three sides have one row per employee and are joined first, so the result
    # is as long as the salary table.
    last_title = latest(views.titles(spark, sf_dir), "emp_no", "title", "last_title")
    person = views.employees(spark, sf_dir).join(last_title, "emp_no")
    paid = views.salaries(spark, sf_dir).select("emp_no", "id", "salary")
    return skew.attach_per_key(paid, person, "emp_no").select("emp_no", "id", "salary", "name", "last_title")


@query("join_using_range", "SELECT event_id AS id, user_id FROM events WHERE event_id < (SELECT count(*) FROM orders)")
def join_using_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = spark.range(table(spark, sf_dir, "orders").count())
    seen = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "user_id")
    return ids.join(seen, "id")


def _dear(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 400000)
    return chosen.select(F.col("o_custkey").alias("custkey"), "o_orderkey")


def _in_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 5000)
    return chosen.select(F.col("c_custkey").alias("custkey"), "c_name")


_SIDES = """(SELECT o_custkey AS custkey, o_orderkey FROM orders WHERE o_totalprice > 400000) o {kind} JOIN
            (SELECT c_custkey AS custkey, c_name FROM customer WHERE c_acctbal > 5000) c USING (custkey)"""


@query("join_left", f"SELECT custkey, o_orderkey, c_name FROM {_SIDES.format(kind='LEFT')}")
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dear(spark, sf_dir).join(_in_credit(spark, sf_dir), "custkey", "left")


@query(
    "join_right",
    """SELECT custkey, c_name, o_orderkey FROM
       (SELECT c_custkey AS custkey, c_name FROM customer WHERE c_acctbal > 5000) RIGHT JOIN
       (SELECT o_custkey AS custkey, o_orderkey FROM orders WHERE o_totalprice > 400000) USING (custkey)""",
)
def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_credit(spark, sf_dir).join(_dear(spark, sf_dir), "custkey", "right")


@query("join_full", f"SELECT custkey, CAST(o_orderkey AS VARCHAR) AS order_id, c_name FROM {_SIDES.format(kind='FULL')}")
def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    met = full_outer(_dear(spark, sf_dir), _in_credit(spark, sf_dir), "custkey")
    return met.select("custkey", F.col("o_orderkey").cast("string").alias("order_id"), "c_name")


@query(
    "join_semi",
    """SELECT c_custkey AS custkey, c_name FROM customer WHERE c_acctbal > 5000
       AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _dear(spark, sf_dir).select("custkey").distinct()
    return _in_credit(spark, sf_dir).join(keys, "custkey", "left_semi")


@query(
    "join_anti",
    """SELECT c_custkey AS custkey, c_name FROM customer WHERE c_acctbal > 5000
       AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _dear(spark, sf_dir).select("custkey").distinct()
    return _in_credit(spark, sf_dir).join(keys, "custkey", "left_anti")


@query(
    "join_cross",
    """SELECT c_custkey AS custkey, priority, count(o_orderkey) AS orders
       FROM customer CROSS JOIN (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']) AS priority)
       LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = priority GROUP BY c_custkey, priority""",
)
def join_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = pair_with_each(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey")), "priority", PRIORITIES
    )
    counted = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority"))
        .agg(F.count("*").alias("orders"))
    )
    return grid.join(counted, ["custkey", "priority"], "left").withColumn("orders", F.coalesce("orders", F.lit(0)))
