"""Blog authors and the hits on their pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.registry import query


@query("blogs_hits_x2", "SELECT Id, Hits * 2 AS hits_x2 FROM v_blogs")
def blogs_hits_x2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.blogs(spark, sf_dir).selectExpr("Id", "Hits * 2 AS hits_x2")


@query("blogs_hits_plus_id", "SELECT Id, Hits + Id AS hits_plus_id FROM v_blogs")
def blogs_hits_plus_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.blogs(spark, sf_dir).select("Id", (F.col("Hits") + F.col("Id")).alias("hits_plus_id"))


@query(
    "blogs_big_hitters",
    """SELECT Id, "First", "Last", Url, Published, Hits, array_to_string(Campaigns, ',') AS Campaigns,
              Hits > 10000 AS big_hitters FROM v_blogs""",
)
def blogs_big_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = views.blogs(spark, sf_dir).withColumn("big_hitters", F.expr("Hits > 10000"))
    return flagged.withColumn("Campaigns", F.array_join("Campaigns", ","))


@query("blogs_author_id", 'SELECT concat("First", "Last", Id) AS author_id FROM v_blogs')
def blogs_author_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.blogs(spark, sf_dir).selectExpr("concat(First, Last, string(Id)) AS author_id")
