"""Tables of a relational database."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Stride:
    """How to cut a table into ranges of a numeric column, read in parallel."""

    column: str
    lower: int
    upper: int
    parts: int


def jdbc_options(
    url: str, driver: str, user: str, password: str, table: str, stride: Stride | None = None, fetch_rows: int = 10_000
) -> dict[str, str]:
    options = {
        "url": url,
        "driver": driver,
        "user": user,
        "password": password,
        "dbtable": table,
        "fetchsize": str(fetch_rows),
    }
    if stride is not None:
        options |= {
            "partitionColumn": stride.column,
            "lowerBound": str(stride.lower),
            "upperBound": str(stride.upper),
            "numPartitions": str(stride.parts),
        }
    return options


def jdbc_loader(
    spark: SparkSession, url: str, driver: str, user: str, password: str
) -> Callable[..., DataFrame]:
    """A function that loads any table of one database by name.

    Without a stride the whole table passes through a single task, so give one for any
    table that is not small. Filters and column choices are pushed to the database.
    """

    def load(table: str, stride: Stride | None = None) -> DataFrame:
        return spark.read.format("jdbc").options(**jdbc_options(url, driver, user, password, table, stride)).load()

    return load
