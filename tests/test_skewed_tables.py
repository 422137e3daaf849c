"""The same questions on tables where one key holds a third of the rows."""

import duckdb
import pytest

from conftest import SF_DIR, TABLES
from sparkwell.all_queries import all_oracles, all_queries

ONE_THIRD = {
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey",
    "lineitem": """CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_suppkey END AS l_suppkey,
                   CASE WHEN l_partkey % 3 = 1 THEN 10 ELSE l_orderkey END AS l_orderkey""",
    "events": "CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id",
    "part": "CASE WHEN p_partkey % 3 = 0 THEN 'Brand#4' ELSE p_brand END AS p_brand",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for name in TABLES.split():
        change = f"REPLACE ({ONE_THIRD[name]})" if name in ONE_THIRD else ""
        connection.execute(f"COPY (SELECT * {change} FROM '{SF_DIR}/{name}.parquet') TO '{folder}/{name}.parquet'")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), connection


@pytest.mark.parametrize(
    "key",
    [
        "agg_collect_list",
        "agg_summary_by",
        "flights_q3_case",
        "flights_window_top3",
        "grp_subtract_mean_builtin",
        "grp_subtract_mean_lists",
        "grp_subtract_mean_pandas",
        "hr_all_info",
        "hr_latest",
        "join_anti",
        "join_bucketed",
        "join_cross",
        "join_full",
        "join_multiway",
        "join_overlapping",
        "join_right",
        "join_sort_merge",
        "layout_rows_by_key",
        "win_frame_last_value",
        "win_frame_rows",
        "win_last_value_range",
        "win_rank_vs_dense",
        "win_running_rows",
    ],
)
def test_same_rows_on_skewed_tables(key, spark, skewed, no_broadcast):
    folder, connection = skewed
    df = all_queries()[key](spark, folder)
    answer = connection.execute(all_oracles()[key])
    names = [column[0] for column in answer.description]
    expected = sorted(map(repr, answer.fetchall()))
    assert sorted(repr(tuple(row[name] for name in names)) for row in df.collect()) == expected
