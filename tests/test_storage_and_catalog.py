"""Files, tables, views and caches."""

import glob
import uuid

import pytest
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sparkwell import storage, views
from sparkwell.all_queries import all_queries
from sparkwell.plans import catalog, layout
from sparkwell.sinks import writers
from sparkwell.sources import jdbc, readers
from sparkwell.sources import queries as sources
from sparkwell.tables import table


def part_files(path):
    return glob.glob(f"{path}/part-*")


def test_files_follow_partitions(spark, tmp_path):
    rows = spark.range(1000)
    for n in (1, 3, 7):
        path = str(tmp_path / f"p{n}")
        writers.save(rows.repartition(n), "parquet", path)
        assert len(part_files(path)) == n
    assert rows.repartition(16).rdd.getNumPartitions() == 16
    assert rows.repartition(16).coalesce(4).rdd.getNumPartitions() == 4


def test_a_report_is_one_file(spark, tmp_path):
    path = str(tmp_path / "one")
    rows = spark.range(1000).repartition(5).selectExpr("id % 3 AS k", "id AS v")
    writers.save_report(rows, ["k"], "v", "csv", path)
    assert len(part_files(path)) == 1 and spark.read.csv(path).count() == 3


def test_strict_csv_aborts_on_a_malformed_row(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,x\noops,y\n")
    path = str(tmp_path / "bad.csv")
    lenient = readers.read_csv(spark, path, "a INT, b STRING")
    assert sorted(map(tuple, lenient.collect()), key=repr) == [(1, "x"), (None, "y")]
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        readers.read_csv(spark, path, "a INT, b STRING", strict=True).collect()


def test_empty_csv_field_is_null(spark, tmp_path):
    (tmp_path / "gap.csv").write_text("a\tb\n1\t\n2\tx\n")
    found = readers.read_csv(spark, str(tmp_path / "gap.csv"), "a INT, b STRING", sep="\t").orderBy("a").collect()
    assert [r.b for r in found] == [None, "x"]


def test_csv_timestamps_come_back_as_text_without_a_schema(spark, tmp_path):
    rows = spark.sql("SELECT TIMESTAMP_NTZ'2018-01-02 03:04:05' AS t")
    path = str(tmp_path / "t")
    writers.save(rows, "csv", path, header="true")
    assert spark.read.option("header", True).csv(path).dtypes == [("t", "string")]
    assert spark.read.option("header", True).schema(rows.schema).csv(path).first() == rows.first()


def test_json_orders_columns_by_name_unless_told(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x")], "b INT, a STRING")
    path = str(tmp_path / "j")
    writers.save(rows, "json", path)
    assert readers.read_json(spark, path).columns == ["a", "b"]
    assert readers.read_json(spark, path, rows.schema).columns == ["b", "a"]


def test_schema_survives_as_json(spark, tmp_path):
    for schema in (sources.CALLS, sources.BLOGS):
        path = str(tmp_path / uuid.uuid4().hex)
        readers.save_schema(spark, schema, path)
        assert readers.load_schema(spark, path) == schema


def test_schema_as_ddl(spark):
    df = spark.createDataFrame([], sources.FLIGHTS)
    assert df.schema.simpleString() == "struct<date:string,delay:int,distance:int,origin:string,destination:string>"
    assert [f.nullable for f in sources.CALLS.fields] == [True] * len(sources.CALLS.fields)


def test_recursive_look_up_takes_no_partition_column(spark, sf_dir):
    folder = sources.bar_pictures(spark, sf_dir)
    assert "nation" in readers.read_binary(spark, folder, "*.txt").columns
    assert "nation" not in readers.read_binary(spark, folder, "*.txt", recursive=True).columns
    groups = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    pictures = groups.select("c_nationkey", F.trunc("o_orderdate", "month")).distinct().count()
    assert len(glob.glob(f"{folder}/nation=*/month=*/part-*")) == pictures > 500
    assert readers.read_binary(spark, folder, "*.png", recursive=True).count() == 0


def test_few_gzip_files_are_spread(spark, tmp_path):
    path = str(tmp_path / "gz")
    spark.range(100).selectExpr("string(id) AS value").coalesce(1).write.option("compression", "gzip").text(path)
    lines = readers.read_gzip_text(spark, path)
    assert lines.count() == 100
    assert lines.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_avro_when_the_module_is_there(spark, sf_dir):
    if not readers.has_avro(spark):
        pytest.skip("the Avro module is not installed")
    assert writers.round_trip(views.usage(spark, sf_dir), "avro").count() == views.usage(spark, sf_dir).count()


def test_jdbc_options_cut_a_table_into_ranges():
    plain = jdbc.jdbc_options("jdbc:x:y", "d.D", "u", "p", "employees")
    assert plain["dbtable"] == "employees" and "partitionColumn" not in plain
    cut = jdbc.jdbc_options("jdbc:x:y", "d.D", "u", "p", "salaries", jdbc.Stride("emp_no", 1, 1000, 10))
    assert {k: cut[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "emp_no", "lowerBound": "1", "upperBound": "1000", "numPartitions": "10",
    }


def test_views_come_and_go(spark):
    spark.range(3).createOrReplaceTempView("short_lived")
    spark.range(3).createOrReplaceGlobalTempView("short_lived")
    assert spark.newSession().table("global_temp.short_lived").count() == 3
    with pytest.raises(AnalysisException):
        spark.newSession().table("short_lived").count()
    spark.sql("DROP VIEW IF EXISTS short_lived")
    spark.sql("DROP VIEW IF EXISTS global_temp.short_lived")
    for name in ("short_lived", "global_temp.short_lived"):
        with pytest.raises(AnalysisException):
            spark.table(name).count()


def test_databases_and_tables_come_and_go(spark, sf_dir):
    database = storage.new_database(spark)
    assert database in [d.name for d in spark.catalog.listDatabases()]
    writers.save_table(spark.range(5), f"{database}.kept")
    catalog.external_csv_table(
        spark, f"{database}.outside", sources.FLIGHTS, sources.csv_copy(spark, sf_dir, "flights")
    )
    kinds = {t.name: t.tableType for t in spark.catalog.listTables(database) if not t.isTemporary}
    assert kinds == {"kept": "MANAGED", "outside": "EXTERNAL"}
    assert [c.name for c in spark.catalog.listColumns(f"{database}.outside")][:2] == ["date", "delay"]
    path = sources.csv_copy(spark, sf_dir, "flights")
    spark.sql(f"DROP TABLE IF EXISTS {database}.outside")
    assert part_files(path), "dropping an external table keeps its files"
    spark.sql(f"USE {database}")
    assert spark.catalog.currentDatabase() == database
    spark.sql("USE default")
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    assert database not in [d.name for d in spark.catalog.listDatabases()]


def test_the_life_of_a_table_leaves_nothing(spark, sf_dir):
    before = {d.name for d in spark.catalog.listDatabases()}, {t.name for t in spark.catalog.listTables()}
    steps = all_queries()["cat_table_life"](spark, sf_dir).orderBy("step").collect()
    assert [r.action for r in steps if r.present] == ["create view", "create table", "cache table", "uncache table"]
    assert [r.action for r in steps if r.cached] == ["cache table"]
    assert len({r.n for r in steps if r.present}) == 1 and all(r.n is None and r.ddl is None for r in steps if not r.present)
    assert before == ({d.name for d in spark.catalog.listDatabases()}, {t.name for t in spark.catalog.listTables()})


def test_the_life_of_an_empty_table_with_odd_columns(spark):
    database = storage.new_database(spark)
    rows = spark.createDataFrame([], "n long, step array<struct<a: int, b: string>>")
    steps = catalog.life_of_table(spark, database, "empty", rows).collect()
    assert {r.n for r in steps if r.present} == {0}
    assert {r.ddl for r in steps if r.present} == {"n BIGINT,step ARRAY<STRUCT<a: INT, b: STRING>>"}
    assert not spark.catalog.listTables(database) or {t.isTemporary for t in spark.catalog.listTables(database)} == {True}


def test_a_failed_step_leaves_no_view_and_no_table(spark):
    database = storage.new_database(spark)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        catalog.life_of_table(spark, database, "broken", broken)
    assert not spark.catalog.tableExists(f"{database}.broken") and not spark.catalog.tableExists(f"{database}_broken")


def test_files_with_rows_are_counted(spark, tmp_path):
    rows = spark.range(1000)
    for n in (2, 5):
        path = str(tmp_path / f"f{n}")
        writers.save(rows.repartition(n), "json", path)
        counts = [r.n for r in writers.files_of(spark, "json", path).collect()]
        assert len(counts) == n and sum(counts) == 1000 and max(counts) - min(counts) <= 8, "round-robin of at most 8 partitions"
    path = str(tmp_path / "none")
    writers.save(rows.filter("id < 0"), "parquet", path)
    assert writers.files_of(spark, "parquet", path).count() == 0


def test_cached_tables_are_known_and_shared(spark):
    spark.range(100).selectExpr("id", "id * id AS square").createOrReplaceTempView("cache_me")
    spark.sql("CACHE TABLE cache_me")
    assert spark.catalog.isCached("cache_me")
    spark.sql("UNCACHE TABLE cache_me")
    assert not spark.catalog.isCached("cache_me")
    held = spark.range(50).selectExpr("id * 3 AS x").persist(StorageLevel.DISK_ONLY)
    held.count()
    assert held.storageLevel.useDisk and not held.storageLevel.useMemory
    twin = spark.range(50).selectExpr("id * 3 AS x")
    assert "InMemoryTableScan" in twin._jdf.queryExecution().executedPlan().toString()
    held.unpersist()
    assert not held.storageLevel.useDisk


def test_disk_cache_is_gone_after_use(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 7 AS k")
    found = layout.from_disk_cache(rows, lambda df: df.groupBy("k").count(), str(tmp_path / "r"))
    assert found.count() == 7 and not rows.storageLevel.useDisk


def test_the_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert storage.new_path(spark, "x").startswith(named.rstrip("/"))
    assert storage.new_path(spark, "x") != storage.new_path(spark, "x")


def test_key_partitioning_keeps_a_key_together(spark, sf_dir):
    rows = spark.range(100).withColumn("k", F.col("id") % 5).repartition(8, "k")
    assert layout.rows_per_partition(rows).agg(F.sum("n")).first()[0] == 100
    placed = rows.withColumn("part", F.spark_partition_id())
    together = placed.groupBy("k").agg(F.countDistinct("part").alias("parts"))
    assert [r.parts for r in together.collect()] == [1] * 5


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://cluster"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session())


def test_repeated_calls_make_no_more_databases(spark, sf_dir):
    def names():
        return {d.name for d in spark.catalog.listDatabases() if d.name.startswith("sparkwell_")}

    keys = ["cat_managed_table", "cat_external_table", "sink_ctas", "sink_save_as_table"]
    first = [all_queries()[k](spark, sf_dir).count() for k in keys]
    made = names()
    assert [all_queries()[k](spark, sf_dir).count() for k in keys] == first and names() == made
    storage.drop_databases(spark)
    assert names() == set()
    assert [all_queries()[k](spark, sf_dir).count() for k in keys] == first


def test_a_copy_follows_its_source(spark, tmp_path):
    folder = str(tmp_path / "tables")

    def copy():
        return storage.staged(spark, "follow", folder, lambda path: spark.read.parquet(f"{folder}/t.parquet").write.parquet(path))

    spark.range(3).write.parquet(f"{folder}/t.parquet")
    one = copy()
    assert copy() == one and spark.read.parquet(one).count() == 3
    spark.range(7).write.mode("append").parquet(f"{folder}/t.parquet")
    assert copy() != one and spark.read.parquet(copy()).count() == 10


def test_clear_leaves_nothing_behind(spark, sf_dir, tmp_path, monkeypatch):
    storage.drop_databases(spark)
    monkeypatch.setattr(storage, "shared_folder", lambda _: str(tmp_path))
    for key in ("cat_managed_table", "src_orc", "sink_parquet_roundtrip"):
        all_queries()[key](spark, sf_dir).count()
    assert list(tmp_path.rglob("*.parquet"))
    storage.clear(spark)
    assert not list(tmp_path.rglob("*.parquet")) and all_queries()["src_orc"](spark, sf_dir).count() > 0
    storage.clear(spark)


def test_passing_tables_go_and_kept_ones_stay(spark):
    with storage.passing(spark) as written:
        for label in ("gone", "kept"):
            spark.range(3).write.parquet(storage.new_path(spark, label))
        gone, kept = written
        written.remove(kept)
    assert spark.read.parquet(kept).count() == 3
    with pytest.raises(AnalysisException):
        spark.read.parquet(gone)
    assert storage.new_path(spark, "later") not in written


def test_a_copy_follows_the_tables_it_reads_and_no_others(spark, tmp_path):
    folder, made = str(tmp_path), []
    for name in ("read", "other"):
        spark.range(3).write.parquet(f"{folder}/{name}.parquet")

    def copy():
        def write(path):
            made.append(path)
            table(spark, folder, "read").write.parquet(path)

        return storage.staged(spark, "by-table", folder, write)

    def of_copy():
        return storage.staged(spark, "of-copy", folder, lambda path: spark.read.parquet(copy()).write.parquet(path))

    first, second = copy(), of_copy()
    spark.range(4).write.mode("overwrite").parquet(f"{folder}/other.parquet")
    assert copy() == first and of_copy() == second and len(made) == 1
    spark.range(5).write.mode("overwrite").parquet(f"{folder}/read.parquet")
    assert of_copy() != second and spark.read.parquet(of_copy()).count() == 5 and len(made) == 2


def test_generated_rows_follow_their_seeds(spark):
    seeds = spark.createDataFrame([(5, 9, 1), (2, 9, 7), (5, 9, 1)], "t long, u long, s long")
    made = sources.synthetic_orders(seeds, "t", "u", F.col("s"))
    again = sources.synthetic_orders(seeds.repartition(3), "t", "u", F.col("s"))
    assert sorted(made.collect()) == sorted(again.collect()) == [(2, 9, 10, 17.25), (5, 9, 7, 39.0), (5, 9, 7, 39.0)]
    assert [tuple(r) for r in sources.synthetic_usage(seeds.limit(1), "t", "s").collect()] == [(5, "user-000000000005", 5 * 7919 % 1000 + 17)]
