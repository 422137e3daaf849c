"""Choosing, computing, renaming and reshaping columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwell import storage, views
from sparkwell.functions.conditions import usage_cost
from sparkwell.registry import query
from sparkwell.tables import table


def reshape(rows: DataFrame, names: dict[str, str], schema: str | None = None) -> DataFrame:
    """The given columns, in order, under new names; with a schema also in its types, or an error."""
    renamed = rows.select(*[F.col(old).alias(new) for old, new in names.items()])
    return renamed if schema is None else renamed.to(T.StructType.fromDDL(schema))


@query("proj_select", 'SELECT State, Color, "Count" FROM v_sales')
def proj_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales(spark, sf_dir).select("State", "Color", "Count")


@query("proj_arith", "SELECT Id, Hits * 2 AS doubled, Hits + Id AS shifted, Id * Id AS squared FROM v_blogs")
def proj_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits, ident = F.col("Hits"), F.col("Id")
    return views.blogs(spark, sf_dir).select(
        "Id", (hits * 2).alias("doubled"), (hits + ident).alias("shifted"), (ident * ident).alias("squared")
    )


@query("proj_bool_flag", 'SELECT Id, "Last", Hits, Hits > 10000 AS big_hitter FROM v_blogs')
def proj_bool_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    authors = views.blogs(spark, sf_dir).select("Id", "Last", "Hits")
    return authors.withColumn("big_hitter", F.col("Hits") > F.lit(10000))


@query("proj_concat", 'SELECT concat("First", "Last", Id) AS author_id FROM v_blogs')
def proj_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.blogs(spark, sf_dir).select(F.concat("First", "Last", F.col("Id").cast("string")).alias("author_id"))


@query("proj_star_expr", "SELECT *, usage * 2 AS doubled FROM v_usage")
def proj_star_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.usage(spark, sf_dir).selectExpr("*", "usage * 2 AS doubled")


@query("proj_add_drop_rename", "SELECT uid, uname AS login, usage * 60 AS seconds FROM v_usage")
def proj_add_drop_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = views.usage(spark, sf_dir).withColumn("seconds", F.col("usage") * 60)
    return timed.drop("usage").withColumnRenamed("uname", "login")


@query(
    "proj_cast",
    """SELECT id, CAST(salary AS DOUBLE) AS salary, coalesce(TRY_CAST(firstName AS INT), -1) AS not_a_number,
              CAST(birthDate AS TIMESTAMP) AS born FROM v_people""",
)
def proj_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.people(spark, sf_dir).select(
        "id",
        F.col("salary").cast("double").alias("salary"),
        F.coalesce(F.col("firstName").try_cast("int"), F.lit(-1)).alias("not_a_number"),
        F.col("birthDate").cast("timestamp_ntz").alias("born"),
    )


@query("proj_nested_field", "SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders")
def proj_nested_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        paid = F.struct(
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("price"),
            F.col("o_orderpriority").alias("priority"),
        )
        table(spark, sf_dir, "orders").select("o_orderkey", paid.alias("paid")).write.parquet(path)

    nested = spark.read.parquet(storage.staged(spark, "nested-orders", sf_dir, write))
    return nested.select("o_orderkey", "paid.status", F.col("paid")["price"].alias("price"))


@query(
    "proj_typed_reshape",
    """SELECT temp, device_name AS name, device_id AS device, cca3 AS country FROM v_iot WHERE temp > 25""",
)
def proj_typed_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    warm = views.iot(spark, sf_dir).filter(F.col("temp") > 25)
    return reshape(warm, {"temp": "temp", "device_name": "name", "device_id": "device", "cca3": "country"})


@query(
    "proj_usage_cost",
    """SELECT uid, uname, usage, round(CASE WHEN usage > 750 THEN usage * 0.15::DOUBLE ELSE usage * 0.5::DOUBLE END, 4)
              AS cost FROM v_usage""",
)
def proj_usage_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.usage(spark, sf_dir).withColumn("cost", F.round(usage_cost(F.col("usage")), 4))
