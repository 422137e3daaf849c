"""Joins and layouts that stay balanced when one key holds a large share of the rows.

Adaptive execution splits a skewed partition only where both join inputs come straight
from a shuffle. Where one input is an aggregate on the same key, or a bucketed table, it
cannot; the helpers here cover those cases.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwell.session import shuffle_partitions


def fair_share(rows: DataFrame) -> float:
    """The fraction of rows one shuffle partition should hold."""
    return 1.0 / max(shuffle_partitions(rows.sparkSession), 8)


def hot_keys(rows: DataFrame, key: str, share: float | None = None) -> list[tuple]:
    """(key, salts) for keys with more than ``share`` of all rows; null counts as a key.

    At most ``1 / share`` keys can qualify, however long the table is, so the list is small.
    A key's salts are its rows over a fair share, rounded up; all salts together are fewer than
    ``2 / share``. Counting reads one column and combines before the shuffle.
    """
    limit = share if share is not None else fair_share(rows)
    per_key = rows.groupBy(key).agg(F.count("*").alias("rows_of_key"))
    total = per_key.agg(F.sum("rows_of_key").alias("rows_in_all"))
    fair = F.lit(limit) * F.col("rows_in_all")
    hot = per_key.join(F.broadcast(total), F.col("rows_of_key") > fair)
    salts = F.ceil(F.col("rows_of_key") / F.greatest(fair, F.lit(1.0))).cast("int")
    return [(row[0], row[1]) for row in hot.select(key, salts.alias("salts")).collect()]


def salts_of(key: str, hot: Sequence[tuple]) -> Column:
    """How many salts a key has: 1 unless it is hot."""
    found = F.lit(1)
    for salts in sorted({salts for _, salts in hot}):
        some = [value for value, n in hot if n == salts and value is not None]
        found = F.when(F.col(key).isin(some), salts).otherwise(found) if some else found
    of_null = next((salts for value, salts in hot if value is None), 1)
    return F.when(F.col(key).isNull(), of_null).otherwise(found)


def salt_many(rows: DataFrame, key: str, spread_by: Sequence[str], hot: Sequence[tuple]) -> DataFrame:
    """Add ``salt``: a hot key's rows are spread over its salts by a hash of the row, all others keep 0."""
    return rows.withColumn("salt", F.pmod(F.xxhash64(*spread_by), salts_of(key, hot)).cast("int"))


def salt_one(per_key: DataFrame, key: str, hot: Sequence[tuple]) -> DataFrame:
    """The other side of :func:`salt_many`: a row for each salt of its key, one for most."""
    return per_key.withColumn("salt", F.explode(F.sequence(F.lit(0), salts_of(key, hot) - 1)))


def attach_per_key(
    rows: DataFrame, per_key: DataFrame, key: str, share: float | None = None, null_is_key: bool = False
) -> DataFrame:
    """``rows`` inner-joined to ``per_key``, which has one row for each key.

    Without a hot key this is a plain join. Else rows are salted and only the single rows of
    hot keys are repeated, so it stays one join and reads ``rows`` no more often. Rows
    without a key are dropped, as in any inner join, unless null is a key like the others, as it
    is in a grouping.
    """
    other = f"{key}_of_group"
    per_key = per_key.withColumnRenamed(key, other)
    same = F.col(key).eqNullSafe(F.col(other)) if null_is_key else F.col(key) == F.col(other)
    hot = hot_keys(rows, key, share)
    if not hot:
        return rows.join(per_key, same).drop(other)
    spread = [c for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    numbered = rows.withColumn("row_number_in_scan", F.monotonically_increasing_id())
    many = salt_many(numbered, key, [*spread, "row_number_in_scan"], hot).drop("row_number_in_scan")
    one = salt_one(per_key, other, hot).withColumnRenamed("salt", "salt_of_group")
    return many.join(one, same & (F.col("salt") == F.col("salt_of_group"))).drop(other, "salt", "salt_of_group")


def at_most(small: DataFrame, max_rows: int) -> bool:
    """Whether ``small`` has no more than ``max_rows`` rows; reads only as far as it must, and counts where the rows are."""
    return small.limit(max_rows + 1).count() <= max_rows


def _width(small: DataFrame) -> Column:
    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(field.name)))
        return F.lit(16)

    return reduce(operator.add, [F.coalesce(width(field), F.lit(0)) + 8 for field in small.schema.fields])


def bytes_of(small: DataFrame) -> int:
    """About how large the rows are in memory: 16 bytes a number, and every byte of a text or a nested value."""
    return small.agg(F.sum(_width(small))).first()[0] or 0


def broadcast_if_small(small: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Ask for a broadcast only when rows and bytes have been checked; otherwise leave the choice to Spark."""
    part = small.limit(max_rows + 1)
    rows, size = part.agg(F.count("*"), F.coalesce(F.sum(_width(part)), F.lit(0))).first()
    return F.broadcast(small) if rows <= max_rows and size <= max_bytes else small
