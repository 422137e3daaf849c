"""User-defined functions, each beside the built-in expression that gives the same result.

Python code receives Arrow batches, never single pickled rows. Where one group may hold a
large share of the table, the grouped function gets it in pieces.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwell import storage, views
from sparkwell.functions.clock import compact_text
from sparkwell.operators.scans import running
from sparkwell.registry import query
from sparkwell.skew import attach_per_key, hot_keys, salt_many, salt_one
from sparkwell.tables import table

# Executors need not have this package: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def cube_int(n: int | None) -> int | None:
    return None if n is None else n**3


def stamp_text(text: str | None) -> str | None:
    if text is None:
        return None
    return f"{text[0:2]}/{text[2:4]} {text[4:6]}:{text[6:8]}"


def add_one_to_each(values: list[int] | None) -> list[int] | None:
    return None if values is None else [v + 1 for v in values]


def register_all(spark: SparkSession) -> None:
    """Make the scalar functions callable from SQL text."""
    spark.udf.register("cube_int", F.udf(cube_int, T.LongType(), useArrow=True))
    spark.udf.register("stamp_text", F.udf(stamp_text, T.StringType(), useArrow=True))
    spark.udf.register("add_one_to_each", F.udf(add_one_to_each, T.ArrayType(T.IntegerType()), useArrow=True))


@F.udf(returnType=T.DoubleType(), useArrow=True)
def plus_one(v: float) -> float:
    return None if v is None else v + 1.0


@F.pandas_udf(T.DoubleType())
def plus_one_batch(v: pd.Series) -> pd.Series:
    return v + 1.0


LARGEST_CUBED = 2_097_151


def _cube_series(n: pd.Series) -> pd.Series:
    """A batch with a null arrives as floats; cubes are made of whole numbers all the same, and overflow is an error."""
    whole = n.astype("Int64")
    if (whole.abs() > LARGEST_CUBED).any():
        raise OverflowError("the cube does not fit a long")
    return whole**3


cube_batch = F.pandas_udf(_cube_series, T.LongType())


class RootWriter:
    """A resource that is costly to open: opened once for a partition, it takes every root of its batches as a line.

    Full blocks leave it for Spark's own writer, which publishes a task's lines when the task
    succeeds. So a task that is tried again leaves nothing twice, in any file system.
    """

    def __init__(self, block_chars: int = 1 << 20):
        self.block_chars = block_chars

    def __enter__(self) -> RootWriter:
        self.buffer = io.StringIO()
        return self

    def __exit__(self, *failure: object) -> None:
        self.buffer.close()

    def write(self, ids: pd.Series, squares: pd.Series) -> Iterator[str]:
        pd.DataFrame({"id": ids, "root": np.sqrt(squares)}).to_csv(self.buffer, header=False, index=False)
        if self.buffer.tell() >= self.block_chars:
            yield self.rest()

    def rest(self) -> str:
        """What has been written and not handed on, without the last line break."""
        block = self.buffer.getvalue().removesuffix("\n")
        self.buffer.seek(0)
        self.buffer.truncate()
        return block


def root_lines_per_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    with RootWriter() as writer:
        for batch in batches:
            for block in writer.write(batch["id"], batch["square"]):
                yield pd.DataFrame({"value": [block]})
        if rest := writer.rest():
            yield pd.DataFrame({"value": [rest]})


def write_roots(squares: DataFrame, path: str) -> None:
    """A line ``id,root`` for each row."""
    squares.mapInPandas(root_lines_per_partition, "value string").write.text(path)


def roots_per_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same without a file."""
    for batch in batches:
        yield pd.DataFrame({"id": batch["id"], "root": np.sqrt(batch["square"])})


def subtract_mean(rows: DataFrame, share: float | None = None) -> DataFrame:
    """``v`` minus the mean of its ``id``: means combine before the shuffle, then meet the rows."""
    means = rows.groupBy("id").agg(F.avg("v").alias("mean"))
    return attach_per_key(rows, means, "id", share, null_is_key=True).select("id", (F.col("v") - F.col("mean")).alias("v"))


def _minus_given_mean(piece: pd.DataFrame) -> pd.DataFrame:
    """Null stays null and NaN stays NaN, which pandas alone would not tell apart."""
    value = (piece["v"] - piece["mean"]).to_numpy(np.float64)
    return pd.DataFrame({"id": piece["id"], "v": pd.arrays.FloatingArray(value, ~piece["known"].to_numpy(bool))})


def subtract_mean_in_pandas(rows: DataFrame, share: float | None = None) -> DataFrame:
    """The same with a pandas function per group.

    The mean comes from an ordinary aggregate, so a group can be handed to pandas in pieces and the
    answer doesn't depend on them: an id with more rows than a partition should hold has as many pieces as
    it fills partitions. Rows are shuffled once, by (id, piece), for their join with the means and for pandas alike.
    """
    hot = hot_keys(rows, "id", share)
    numbered = rows.select("id", "v", F.monotonically_increasing_id().alias("row"))
    # Null is an id like any other, told apart by a column of its own: a null-safe join would hash other expressions.
    key = [F.coalesce("id", F.lit(0)).alias("known_id"), F.col("id").isNull().alias("no_id"), "salt"]
    many = salt_many(numbered, "id", ["row"], hot).select(*key, "id", "v")
    means = rows.groupBy("id").agg(F.avg("v").alias("mean"))
    one = salt_one(means, "id", hot).select(*key, "mean").hint("shuffle_hash")
    joined = many.join(one, ["known_id", "no_id", "salt"]).withColumn("known", F.col("v").isNotNull())
    return joined.groupBy("known_id", "no_id", "salt").applyInPandas(_minus_given_mean, "id long, v double")


def subtract_mean_in_lists(rows: DataFrame, most: int = 1024, share: float | None = None) -> DataFrame:
    """The same with lists of structs: at most ``most`` rows of an id to a list, worked on whole and taken apart again.

    A running count within each id numbers its rows, so a frequent id makes more lists, never a longer one.
    """
    numbered = rows.select("id", "v", F.monotonically_increasing_id().alias("row"))
    counted = running(numbered, "id", ("row",), {"nth": ("count", "row")}, share)
    chunk = F.floor((F.col("nth") - 1) / most).alias("chunk")
    lists = counted.groupBy("id", chunk).agg(F.collect_list(F.struct("v")).alias("values"))
    means = rows.groupBy("id").agg(F.avg("v").alias("mean"))
    met = attach_per_key(lists, means, "id", share, null_is_key=True)
    less = F.transform("values", lambda x: F.struct((x["v"] - F.col("mean")).alias("v")))
    return met.select("id", F.inline(less))


@query(
    "udf_cubed_sql",
    "SELECT l_orderkey, l_linenumber, CAST(l_linenumber * l_linenumber * l_linenumber AS BIGINT) AS cubed FROM lineitem",
)
def udf_cubed_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_all(spark)
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("sparkwell_lines")
    return spark.sql("SELECT l_orderkey, l_linenumber, cube_int(l_linenumber) AS cubed FROM sparkwell_lines")


_STAMPS = """SELECT concat(substr(s, 1, 2), '/', substr(s, 3, 2), ' ', substr(s, 5, 2), ':', substr(s, 7, 2)) AS readable,
                    l_orderkey, l_linenumber
             FROM (SELECT strftime(l_shipdate, '%m%d%H%M') AS s, l_orderkey, l_linenumber FROM lineitem)"""


@query("udf_reformat_date", _STAMPS)
def udf_reformat_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_all(spark)
    stamps = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", compact_text(F.col("l_shipdate")).alias("stamp")
    )
    return stamps.selectExpr("stamp_text(stamp) AS readable", "l_orderkey", "l_linenumber")


_PLUS_ONE = """SELECT id, count(v + 1) AS n, round(sum(v + 1), 4) AS total FROM v_grouped GROUP BY id"""


def _per_id(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(F.count("w").alias("n"), F.round(F.sum("w"), 4).alias("total"))


@query("udf_plus_one", _PLUS_ONE)
def udf_plus_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_id(views.grouped_values(spark, sf_dir).withColumn("w", plus_one("v")))


@query("udf_pandas_scalar", _PLUS_ONE)
def udf_pandas_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_id(views.grouped_values(spark, sf_dir).withColumn("w", plus_one_batch("v")))


@query("udf_builtin_plus_one", _PLUS_ONE)
def udf_builtin_plus_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_id(views.grouped_values(spark, sf_dir).withColumn("w", F.col("v") + F.lit(1)))


@query(
    "udf_pandas_cubed",
    "SELECT p_partkey, CAST(p_size * p_size * p_size AS BIGINT) AS cubed FROM part",
)
def udf_pandas_cubed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", cube_batch(F.col("p_size").cast("long")).alias("cubed"))


@query(
    "udf_array_plus_one",
    """SELECT id, array_to_string(list_transform("values", lambda v: v + 1), ',') AS plus_one FROM v_arrays""",
)
def udf_array_plus_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_all(spark)
    added = views.int_arrays(spark, sf_dir).selectExpr("id", "add_one_to_each(values) AS plus_one")
    return added.selectExpr("id", "array_join(transform(plus_one, v -> string(v)), ',') AS plus_one")


_MINUS_MEAN = "SELECT id, v - avg(v) OVER (PARTITION BY id) AS v FROM v_grouped"


@query("grp_subtract_mean_builtin", _MINUS_MEAN)
def grp_subtract_mean_builtin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtract_mean(views.grouped_values(spark, sf_dir))


@query("grp_subtract_mean_pandas", _MINUS_MEAN)
def grp_subtract_mean_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtract_mean_in_pandas(views.grouped_values(spark, sf_dir))


@query("grp_subtract_mean_lists", _MINUS_MEAN)
def grp_subtract_mean_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtract_mean_in_lists(views.grouped_values(spark, sf_dir))


@query("udf_map_partitions", "SELECT id, sqrt(square) AS root FROM v_squares")
def udf_map_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.staged(spark, "roots", sf_dir, lambda path: write_roots(views.squares(spark, sf_dir), path))
    return spark.read.schema("id long, root double").csv(path)
