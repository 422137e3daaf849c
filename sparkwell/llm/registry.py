"""Queries of this subpackage, each beside the same question in DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Runner] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return run

    return register
