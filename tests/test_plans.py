"""The plans are the ones wanted at scale."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from sparkwell.all_queries import all_queries
from sparkwell.studies.ranges import id_sum, join_count


def scans(plan):
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    [scan] = scans(plan_of(all_queries()["src_parquet"](spark, sf_dir)))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in scan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in scan


def test_a_derived_column_prunes_its_inputs(spark, sf_dir):
    [scan] = scans(plan_of(all_queries()["mnm_by_color"](spark, sf_dir)))
    assert "ReadSchema: struct<l_quantity:double,l_linestatus:string>" in scan


def test_origin_filter_reaches_the_scan_of_the_joined_legs(spark, sf_dir):
    [scan] = scans(plan_of(all_queries()["flights_window_top3"](spark, sf_dir)))
    assert "In(origin" in scan and "ReadSchema: struct<delay:int,origin:string,destination:string>" in scan


def test_ranking_keeps_only_the_top_before_the_shuffle(spark, sf_dir):
    plan = plan_of(all_queries()["flights_window_top3"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    for key in ("mnm_summary", "agg_cube", "fire_common_types", "nasa_q2", "agg_pivot_three"):
        plan = plan_of(all_queries()[key](spark, sf_dir))
        assert "partial_" in plan, key


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    for key in ("topk_limit", "flights_top_routes", "nasa_q5", "nasa_q6"):
        plan = plan_of(all_queries()[key](spark, sf_dir))
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan, key


def test_sort_merge_join_shuffles_both_sides(spark, sf_dir):
    plan = plan_of(all_queries()["join_sort_merge"](spark, sf_dir))
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2


def test_bucketed_join_does_not_shuffle(spark, sf_dir):
    plan = plan_of(all_queries()["join_bucketed"](spark, sf_dir))
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_broadcast_join_leaves_the_long_side_in_place(spark, sf_dir):
    plan = plan_of(all_queries()["join_broadcast"](spark, sf_dir))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_latest_records_share_one_partitioning(spark, sf_dir, no_broadcast):
    plan = plan_of(all_queries()["hr_latest"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning(emp_no") == 4
    assert plan.count("Exchange") == 5  # and one for the final order


def test_semi_join_reuses_the_distinct_shuffle(spark, sf_dir, no_broadcast):
    plan = plan_of(all_queries()["join_semi"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 2


def test_no_query_multiplies_two_tables(spark, sf_dir):
    for key in ("join_cross", "join_inner", "join_multiway", "hr_all_info", "flights_q1", "src_literal_rows"):
        plan = plan_of(all_queries()[key](spark, sf_dir))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, key


def test_ranges_run_in_one_generated_stage(spark):
    plan = plan_of(id_sum(spark.range(1000).filter("id > 100")))
    assert "Range (0, 1000" in plan and "partial_sum" in plan
    assert "BroadcastHashJoin" in plan_of(join_count(spark.range(10**6), spark.range(1000)))


def test_a_log_line_meets_the_pattern_once(spark, sf_dir):
    for key in ("nasa_parse", "nasa_q2"):
        plan = plan_of(all_queries()[key](spark, sf_dir))
        assert plan.count("regexp_replace(") == 1 and "RLIKE" not in plan, key


@pytest.mark.parametrize("key", ["arr_transform", "nasa_parse", "agg_pivot_three", "udf_builtin_plus_one", "win_last_record"])
def test_built_in_work_stays_in_the_jvm(spark, sf_dir, key):
    plan = plan_of(all_queries()[key](spark, sf_dir))
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


@pytest.mark.parametrize("key", ["udf_plus_one", "udf_pandas_scalar", "udf_cubed_sql"])
def test_python_functions_get_arrow_batches(spark, sf_dir, key):
    plan = plan_of(all_queries()[key](spark, sf_dir))
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_data_frame_and_sql_text_ask_the_same(spark, sf_dir):
    from sparkwell import views
    from sparkwell.studies.weblogs import requests

    requests(views.log_lines(spark, sf_dir)).createOrReplaceTempView("requests_for_test")
    as_sql = spark.sql(
        "SELECT request_method, count(request_method) AS total FROM requests_for_test GROUP BY request_method"
    )
    as_frame = all_queries()["nasa_q3"](spark, sf_dir)
    assert sorted(map(tuple, as_sql.collect())) == sorted(map(tuple, as_frame.collect()))
    flights = views.flights(spark, sf_dir)
    flights.createOrReplaceTempView("flights_for_test")
    text = "SELECT origin, destination, sum(delay) AS t FROM flights_for_test WHERE origin = 'NATION_3' GROUP BY ALL"
    frame = flights.filter(F.col("origin") == "NATION_3").groupBy("origin", "destination").agg(F.sum("delay"))
    assert sorted(map(tuple, spark.sql(text).collect())) == sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("key", ["fire_stats", "fire_years", "agg_count_distinct", "str_reformat_date", "filter_not_null", "fire_common_types"])
def test_no_join_for_columns_that_are_not_used(key, spark, sf_dir):
    assert "Join" not in plan_of(all_queries()[key](spark, sf_dir))


def test_only_the_wanted_nested_fields_are_read(spark, sf_dir):
    plan = all_queries()["proj_nested_field"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,paid:struct<status:string,price:double>>" in plan


@pytest.mark.parametrize("key", ["flights_q1", "flights_q3_case", "flights_q3_when", "flights_pivot"])
def test_legs_are_joined_once_and_not_by_every_query(key, spark, sf_dir):
    plan = plan_of(all_queries()[key](spark, sf_dir))
    assert "Join" not in plan and "flight-legs" in plan


def test_the_joined_legs_shuffle_the_lines_once(spark, sf_dir, no_broadcast):
    from sparkwell import views

    plan = plan_of(views._joined_legs(spark, sf_dir))
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_suppkey" not in plan
    assert plan.count("Exchange hashpartitioning") == 4  # orders meet customers, then lines


def test_legs_are_joined_in_as_many_partitions_as_their_rows_fill(spark, sf_dir, tmp_path, monkeypatch, no_broadcast):
    from sparkwell import session, views

    linked = tmp_path / "sf"
    linked.symlink_to(sf_dir)
    monkeypatch.setattr(session, "ROWS_A_PARTITION", 100, raising=False)
    before = session.shuffle_partitions(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        legs = views.flight_legs(spark, str(linked))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(legs.inputFiles()) > 40 > before == session.shuffle_partitions(spark)
    assert rows_of(legs) == rows_of(views.flight_legs(spark, sf_dir))


@pytest.mark.parametrize("key", ["flights_window_top3", "sink_save_as_table", "cat_external_table"])
def test_a_query_alone_joins_its_legs_in_as_many_partitions_as_their_rows_fill(key, spark, sf_dir, tmp_path, monkeypatch, no_broadcast):
    from sparkwell import session, views

    linked = tmp_path / "sf"
    linked.symlink_to(sf_dir)
    monkeypatch.setattr(session, "ROWS_A_PARTITION", 100, raising=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        alone = rows_of(all_queries()[key](spark, str(linked)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(views.flight_legs(spark, str(linked)).inputFiles()) > 40
    assert alone == rows_of(all_queries()[key](spark, sf_dir))


@pytest.mark.parametrize("key", ["flights_q1", "flights_q3_case", "flights_q3_when"])
def test_legs_are_sorted_in_as_many_ranges_as_their_rows_fill(key, spark, sf_dir, monkeypatch):
    from sparkwell import session

    few = all_queries()[key](spark, sf_dir)
    monkeypatch.setattr(session, "ROWS_A_PARTITION", 100, raising=False)
    many = all_queries()[key](spark, sf_dir)
    plan = plan_of(many)
    assert plan.count("rangepartitioning(") == plan.count("Exchange") == 1
    assert int(re.search(r"rangepartitioning\(.*, (\d+)\), REPARTITION_BY_NUM", plan)[1]) > 40
    assert many.collect() == few.collect()
