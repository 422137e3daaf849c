"""Every query is a function ``(spark, sf_dir) -> DataFrame`` kept under its key.

The second argument of :func:`query` is the same question in DuckDB SQL; any ``v_*`` view
it names is put in front as a common table expression.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkwell.views import VIEW_SQL

Runner = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Runner] = {}
ORACLE: dict[str, str] = {}


def with_views(body: str) -> str:
    """Prefix ``body`` with the definitions of the ``v_*`` views it uses, inner ones first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in VIEW_SQL and name not in needed:
                visit(VIEW_SQL[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({VIEW_SQL[name]})" for name in needed)
    return f"WITH {ctes}\n{body}"


def query(key: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = with_views(sql)
        return run

    return register
