"""A local session for tests, the bench and ad-hoc use; a cluster brings its own."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import SparkSession

#: Rows that one task should sort in memory, however few partitions the session asks for. Up to 200 partitions, here 400 million
#: rows, Spark also writes a shuffle without sorting it first, which would spill.
ROWS_A_PARTITION = 2_000_000


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sparkwell")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(spark: SparkSession, rows: int) -> int:
    """The session's shuffle partitions, or as many as ``rows`` fill, if that is more."""
    return max(shuffle_partitions(spark), -(-rows // ROWS_A_PARTITION))


@contextlib.contextmanager
def shuffles_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffles of what runs inside get as many partitions as ``rows`` fill; adaptive execution still joins small and splits skewed ones."""
    number = partitions_for(spark, rows)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}
    before = {name: value for name, value in before.items() if value}
    for name, value in before.items():
        spark.conf.set(name, max(number, int(value)))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
