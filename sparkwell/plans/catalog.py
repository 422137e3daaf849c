"""Views, databases, tables and what the catalog knows about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import storage, views
from sparkwell.registry import query
from sparkwell.sources.queries import FLIGHTS, csv_copy
from sparkwell.tables import table


def fill_counts(spark: SparkSession, name: str) -> DataFrame:
    """For each column the catalog lists: its type and how many rows hold a value. One scan."""
    columns = [(c.name, c.dataType) for c in spark.catalog.listColumns(name)]
    counted = spark.table(name).agg(*[F.count(column).alias(column) for column, _ in columns])
    listed = F.array(
        *[
            F.struct(F.lit(column).alias("column_name"), F.lit(kind).alias("type"), F.col(column).alias("filled"))
            for column, kind in columns
        ]
    )
    return counted.select(F.inline(listed))


def external_csv_table(spark: SparkSession, name: str, columns: str, path: str) -> None:
    """Metadata only: dropping the table keeps the files."""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING csv OPTIONS (path '{path}', header 'true')")


def state_of(spark: SparkSession, name: str) -> tuple[bool, bool, str | None, int | None]:
    """Whether a table or view exists and is cached, its columns as DDL and its number of rows."""
    if not spark.catalog.tableExists(name):
        return False, False, None, None
    rows = spark.table(name)
    return True, spark.catalog.isCached(name), rows.schema.toDDL(), rows.count()


def life_of_table(spark: SparkSession, database: str, name: str, rows: DataFrame) -> DataFrame:
    """(step, action, present, cached, ddl, n): the catalog's word on a table, and a view of its name, after each thing done to them.

    The table is filled from ``rows`` and cached on disk only, so that it may be larger than memory and a
    lost executor costs no more than its blocks. Nothing is left of table and view.
    """
    full, view = f"{database}.{name}", f"{database}_{name}"
    rows.createOrReplaceTempView(view)
    doings = [
        ("create view", view, None),
        ("create table", full, f"CREATE TABLE {full} USING parquet AS SELECT * FROM {view}"),
        ("drop view", view, f"DROP VIEW IF EXISTS {view}"),
        ("cache table", full, f"CACHE TABLE {full} OPTIONS ('storageLevel' 'DISK_ONLY')"),
        ("uncache table", full, f"UNCACHE TABLE IF EXISTS {full}"),
        ("drop table", full, f"DROP TABLE IF EXISTS {full}"),
        ("drop table again", full, f"DROP TABLE IF EXISTS {full}"),
    ]
    seen = []
    try:
        for step, (action, target, statement) in enumerate(doings, 1):
            if statement:
                spark.sql(statement)
            seen.append((step, action, *state_of(spark, target)))
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {view}")
        spark.sql(f"DROP TABLE IF EXISTS {full}")
    return spark.createDataFrame(seen, "step int, action string, present boolean, cached boolean, ddl string, n long")


@query("cat_temp_view", "SELECT * FROM v_usage WHERE usage < 100")
def cat_temp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.usage(spark, sf_dir).createOrReplaceTempView("sparkwell_usage")
    return spark.sql("SELECT * FROM sparkwell_usage WHERE usage < 100")


@query("cat_global_view", "SELECT * FROM v_usage WHERE usage >= 900")
def cat_global_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.usage(spark, sf_dir).createOrReplaceGlobalTempView("sparkwell_usage")
    return spark.newSession().sql("SELECT * FROM global_temp.sparkwell_usage WHERE usage >= 900")


@query("cat_managed_table", "SELECT * FROM v_flights WHERE delay > 2000")
def cat_managed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fill(database: str) -> None:
        spark.sql(f"CREATE TABLE {database}.late ({FLIGHTS}) USING parquet")
        views.flights(spark, sf_dir).filter("delay > 2000").write.insertInto(f"{database}.late")

    return spark.table(f"{storage.database_for(spark, 'late', sf_dir, fill)}.late")


@query("cat_external_table", "SELECT * FROM v_flights")
def cat_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fill(database: str) -> None:
        external_csv_table(spark, f"{database}.flights_csv", FLIGHTS, csv_copy(spark, sf_dir, "flights"))

    return spark.table(f"{storage.database_for(spark, 'flights-csv', sf_dir, fill)}.flights_csv")


@query(
    "cat_list_columns",
    """SELECT 'o_orderkey' AS column_name, 'bigint' AS type, count(o_orderkey) AS filled FROM orders
       UNION ALL SELECT 'o_custkey', 'bigint', count(o_custkey) FROM orders
       UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
       UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders
       UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
       UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""",
)
def cat_list_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("sparkwell_orders")
    return fill_counts(spark, "sparkwell_orders")


@query(
    "cat_table_life",
    """WITH kept AS (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'O'),
            columns_of AS (SELECT 'o_orderkey BIGINT,o_orderpriority STRING,o_totalprice DOUBLE' AS ddl)
       SELECT CAST(step AS INTEGER) AS step, action, present, cached, CASE WHEN present THEN ddl END AS ddl, CASE WHEN present THEN n END AS n
       FROM kept, columns_of, (VALUES (1, 'create view', true, false), (2, 'create table', true, false), (3, 'drop view', false, false),
            (4, 'cache table', true, true), (5, 'uncache table', true, false), (6, 'drop table', false, false),
            (7, 'drop table again', false, false)) AS v (step, action, present, cached)""",
)
def cat_table_life(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").select("o_orderkey", "o_orderpriority", "o_totalprice")
    database = storage.new_database(spark)
    try:
        return life_of_table(spark, database, "open_orders", rows)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
