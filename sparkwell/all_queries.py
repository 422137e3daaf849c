"""Importing this module registers every query."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sparkwell.functions import arrays, conditions, dates, udfs  # noqa: F401
from sparkwell.operators import aggregates, filters, intervals, joins, projections, scans, sorting, windows  # noqa: F401
from sparkwell.plans import catalog, layout  # noqa: F401
from sparkwell.registry import ORACLE, QUERIES, Runner, with_views
from sparkwell.sinks import writers
from sparkwell.sources import queries as sources
from sparkwell.sources.readers import has_avro
from sparkwell.studies import (  # noqa: F401
    blogs,
    fire,
    flights,
    formats,
    hr,
    iot,
    people,
    ranges,
    sales,
    texts,
    usage,
    weblogs,
)

_AVRO: dict[str, Runner] = {
    "src_avro": sources.avro_copy,
    "sink_avro_roundtrip": lambda spark, sf_dir: writers.round_trip(sources.views.flight_summary(spark, sf_dir), "avro"),
}


def _avro() -> dict[str, Runner]:
    """Avro queries exist only in a session that was started with the Avro module."""
    session = SparkSession.getActiveSession()
    return _AVRO if session is not None and has_avro(session) else {}


def all_queries() -> dict[str, Runner]:
    return QUERIES | _avro()


def all_oracles() -> dict[str, str]:
    return ORACLE | {key: with_views("SELECT * FROM v_flight_summary") for key in _avro()}
