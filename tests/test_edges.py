"""Literal inputs with the results worked out by hand."""

import datetime
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkwell.all_queries import all_queries
from sparkwell.functions import arrays, clock, conditions, dates
from sparkwell.functions.udfs import cube_batch, plus_one, plus_one_batch, register_all, roots_per_partition, write_roots
from sparkwell.operators import aggregates, windows
from sparkwell.operators.filters import all_of
from sparkwell.sources import readers
from sparkwell.sources.queries import csv_copy
from sparkwell.studies import fire, hr, iot, people, ranges, sales, usage, weblogs


@pytest.mark.parametrize(
    "delay, open_class, stepped_class",
    [
        (361, "Very Long Delays", "Very Long Delays"),
        (360, "No Delays", "Long Delays"),
        (359, "Long Delays", "Long Delays"),
        (120, "No Delays", "Short Delays"),
        (61, "Short Delays", "Short Delays"),
        (60, "No Delays", "Tolerable Delays"),
        (1, "Tolerable Delays", "Tolerable Delays"),
        (0, "No Delays", "No Delays"),
        (-5, "No Delays", "No Delays"),
    ],
)
def test_two_delay_rules_differ_on_the_bounds(spark, delay, open_class, stepped_class):
    row = spark.range(1).select(
        conditions.delay_class_open(F.lit(delay)), conditions.delay_class_stepped(F.lit(delay))
    ).first()
    assert tuple(row) == (open_class, stepped_class)


def test_status_and_cost_at_their_bounds(spark):
    row = spark.range(1).select(
        conditions.on_time_status(F.lit(10)),
        conditions.on_time_status(F.lit(11)),
        F.round(conditions.usage_cost(F.lit(750)), 4),
        F.round(conditions.usage_cost(F.lit(751)), 4),
    ).first()
    assert tuple(row) == ("On-time", "Delayed", 375.0, 112.65)


def log(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value STRING")


GOOD = 'a.example.com - - [01/Aug/1995:00:00:23 -0400] "GET /x.gif HTTP/1.0" 200 1713'


def test_log_line_to_typed_fields(spark):
    row = weblogs.requests(log(spark, GOOD)).first()
    assert tuple(row) == (
        "a.example.com", "-", "-", datetime.datetime(1995, 8, 1, 0, 0, 23), "GET", "/x.gif", "HTTP/1.0", 200, 1713,
    )


@pytest.mark.parametrize(
    "line",
    [
        "",
        "garbage",
        GOOD + " trailing",
        GOOD.replace("-0400", "+0400"),
        GOOD.replace("GET", "FETCH"),
        GOOD.replace(" HTTP/1.0", ""),
        GOOD.replace("200", "20"),
        "eight blanks a b c d e f g",
    ],
)
def test_lines_in_another_format_are_dropped(spark, line):
    assert weblogs.requests(log(spark, line)).count() == 0


def test_a_dash_for_the_size_is_zero_and_an_impossible_day_is_null(spark):
    lines = log(spark, GOOD.replace("1713", "-"), GOOD.replace("01/Aug", "31/Feb"), GOOD.replace("1713", "many"))
    found = [(r.content_size, r.datetime is None) for r in weblogs.requests(lines).collect()]
    assert found == [(0, False), (1713, True), (None, False)]


def test_a_quote_inside_the_protocol_belongs_to_it(spark):
    row = weblogs.requests(log(spark, GOOD.replace("HTTP/1.0", 'HTTP"/1.0'))).first()
    assert row.protocol == 'HTTP"/1.0'


def test_sub_patterns_fall_back(spark):
    lines = log(spark, GOOD, "nothing here", "bare.host [02/Jan/2000:03:04:05 x")
    assert [tuple(r) for r in weblogs.host_and_date(lines).collect()] == [
        ("a.example.com", "01/08/1995 00:00:23"),
        ("no match", "no match"),
        ("bare.host", "02/01/2000 03:04:05"),
    ]


def test_reduce_divides_without_remainder_from_left_to_right(spark):
    df = spark.createDataFrame(
        [([35, 36, 32, 30, 40, 42, 38],), ([31, 32, 34, 55, 56],)], "celsius ARRAY<INT>"
    )
    found = df.select(
        arrays.mean_fahrenheit(F.col("celsius")),
        arrays.to_fahrenheit(F.col("celsius")),
        arrays.above(F.col("celsius"), 38),
        arrays.holds(F.col("celsius"), 38),
    ).collect()
    assert tuple(found[0]) == (96, [95, 96, 89, 86, 104, 107, 100], [40, 42], True)
    assert tuple(found[1]) == (105, [87, 89, 93, 131, 132], [55, 56], False)


def test_regroup_and_array_function_agree(spark):
    register_all(spark)
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [2, 3, 4]), (3, [3, 4, 5])], "id INT, values ARRAY<INT>")
    regrouped = {r.id: r.plus_one for r in arrays.regroup_plus_one(df).collect()}
    by_function = {r.id: r.p for r in df.selectExpr("id", "add_one_to_each(values) AS p").collect()}
    assert regrouped == by_function == {1: [2, 3, 4], 2: [3, 4, 5], 3: [4, 5, 6]}


def test_scalar_functions_pass_nulls(spark):
    register_all(spark)
    df = spark.createDataFrame([(2, "02190925", 1.5), (None, None, None)], "n LONG, s STRING, v DOUBLE")
    found = df.select(
        F.expr("cube_int(n)"), cube_batch("n"), F.expr("stamp_text(s)"), dates.readable_stamp(F.col("s")),
        plus_one("v"), plus_one_batch("v"),
    ).collect()
    assert tuple(found[0]) == (8, 8, "02/19 09:25", "02/19 09:25", 2.5, 2.5)
    assert tuple(found[1]) == (None,) * 6


def test_roots_open_one_writer_for_a_partition(spark):
    df = spark.range(20, numPartitions=4).selectExpr("id", "id * id AS square")
    assert [r.root for r in df.mapInPandas(roots_per_partition, "id long, root double").orderBy("id").collect()] == [
        float(i) for i in range(20)
    ]


def test_pivot_mean_that_does_not_fit_is_null_and_other_months_are_dropped(spark):
    df = spark.createDataFrame(
        [("01010000", 99, "A", "B"), ("01020000", 100, "A", "B"), ("02010000", 500, "A", "B"), ("04010000", 1, "A", "C")],
        "date STRING, delay INT, origin STRING, destination STRING",
    )
    row = aggregates.delay_pivot(df, "A", {"JAN": 1, "FEB": 2}, "decimal(4,2)").collect()
    assert [(r.destination, str(r.JAN_AvgDelay), r.JAN_MaxDelay, r.FEB_AvgDelay, r.FEB_MaxDelay) for r in row] == [
        ("B", "99.50", 100, None, 500)
    ]


def test_ranks_on_ties(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([(v,) for v in (50, 43, 21, 21, 15)], "v INT").withColumn("g", F.lit(1))
    order = Window.partitionBy("g").orderBy(F.desc("v"))
    ranked = df.select("v", F.rank().over(order).alias("r"), F.dense_rank().over(order).alias("d"))
    assert [(r.r, r.d) for r in ranked.orderBy(F.desc("v")).collect()] == [(1, 1), (2, 2), (3, 3), (3, 3), (5, 4)]
    assert windows.top_by_dense_rank(df, "g", "v", 3).count() == 4


def test_latest_takes_the_greater_id_on_equal_dates(spark):
    day = datetime.datetime(2020, 1, 1)
    history = spark.createDataFrame(
        [(1, 7, day, 10.0), (1, 8, day, 20.0), (1, 6, day, 30.0), (2, 1, day, 5.0)],
        "emp_no INT, id INT, to_date TIMESTAMP_NTZ, salary DOUBLE",
    )
    found = windows.latest(history, "emp_no", "salary", "last_salary").orderBy("emp_no").collect()
    assert [tuple(r) for r in found] == [(1, 20.0), (2, 5.0)]


def test_latest_equals_last_over_the_whole_group(spark, sf_dir):
    from pyspark.sql import Window

    from sparkwell import views

    paid = views.salaries(spark, sf_dir)
    order = Window.partitionBy("emp_no").orderBy("to_date", "id")
    by_aggregate = windows.latest(paid, "emp_no", "salary", "last_salary")
    ends = (Window.unboundedPreceding, Window.unboundedFollowing)
    for frame in (order.rangeBetween(*ends), order.rowsBetween(*ends)):
        by_window = paid.select("emp_no", F.last("salary").over(frame).alias("last_salary")).distinct()
        assert sorted(map(tuple, by_window.collect())) == sorted(map(tuple, by_aggregate.collect()))


def test_counts_skip_nulls_and_names_ignore_case(spark):
    calls = spark.createDataFrame(
        [("Fire", 94102), (None, 94102), ("Fire", 94103)], "CallType STRING, Zipcode INT"
    )
    assert [tuple(r) for r in fire.counts(calls, "CallType").collect()] == [("Fire", 2)]
    assert fire.counts(calls, "calltype", "ZipCode").count() == 2


def test_sales_orders_and_state_filter(spark):
    df = spark.createDataFrame(
        [("CA", "Red", 1), ("CA", "Red", 2), ("TX", "Blue", None)], "State STRING, Color STRING, Count INT"
    )
    assert [tuple(r) for r in sales.sales_by(df, "Color").collect()] == [("Red", 2), ("Blue", 0)]
    assert [tuple(r) for r in sales.sales_by(df, "Color", descending=False).collect()] == [("Blue", 0), ("Red", 2)]
    for state, rows in (("CA", 1), ("WA", 0), ("OR", 0), ("UT", 0)):
        assert sales.in_state(df, state).count() == rows


def test_people_conditions_use_the_year_only_and_tolerate_bad_salaries(spark):
    df = spark.createDataFrame(
        [
            ("Dana", "Jones", "1985-01-01", "90000"),
            ("Dana", "Jones", "1984-12-31", "90000"),
            ("Dana", "Jones", "1990-01-01", "unknown"),
            ("Dana", "Jones", "1990-01-01", "80000"),
        ],
        "firstName STRING, lastName STRING, birthDate STRING, salary STRING",
    )
    assert [r.birthDate for r in all_of(df, *people.young_and_paid(2024)).collect()] == ["1985-01-01"]


def test_heavy_usage_is_sorted(spark):
    df = spark.createDataFrame([(1, "a", 901), (2, "b", 999), (3, "c", 900)], "uid INT, uname STRING, usage INT")
    assert [r.uid for r in usage.heavy(df).collect()] == [2, 1]


def test_extremes_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4), (5, 6, 7, 8)], "temp INT, humidity INT, c02_level INT, battery_level INT")
    assert iot.extremes(df).first().asDict() == {
        "min_temp": 1, "max_temp": 5, "min_humidity": 2, "max_humidity": 6,
        "min_c02_level": 3, "max_c02_level": 7, "min_battery_level": 4, "max_battery_level": 8,
    }


def test_a_typed_shape_refuses_other_columns(spark):
    from sparkwell.operators.projections import reshape

    df = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    assert reshape(df, {"a": "n"}, "n LONG").dtypes == [("n", "bigint")]
    with pytest.raises(PySparkException):
        reshape(df, {"b": "n"}, "n LONG, missing STRING NOT NULL").collect()


def test_hr_records_do_not_multiply(spark):
    day = datetime.datetime(2020, 1, 1)
    employees = spark.createDataFrame([(1, "x")], "emp_no INT, name STRING")
    paid = spark.createDataFrame([(1, i, day, 1.0) for i in range(9)], "emp_no INT, id INT, to_date TIMESTAMP_NTZ, salary DOUBLE")
    named = spark.createDataFrame([(1, i, day, "t") for i in range(9)], "emp_no INT, id INT, to_date TIMESTAMP_NTZ, title STRING")
    assert hr.all_info(employees, paid, named).count() == 9


def test_long_id_sums_do_not_overflow(spark):
    n = 2**62
    assert int(ranges.id_sum(spark.range(n - 5, n)).first()[0]) == 5 * n - 15
    assert int(ranges.id_sum(spark.range(-9, 3)).first()[0]) == sum(range(-9, 3))
    assert ranges.id_sum(spark.range(0)).first()[0] is None
    assert {ranges.id_sum(spark.range(m)).dtypes[0][1] for m in (3, 2**33)} == {"decimal(38,0)"}


def test_dates_that_do_not_fit_the_pattern_are_null(spark):
    df = spark.createDataFrame([("01/31/2018",), ("1/2/2018",), ("oops",), (None,)], "d STRING")
    first = datetime.datetime(2018, 1, 31)
    assert [r[0] for r in df.select(clock.parse_day(F.col("d"), "MM/dd/yyyy")).collect()] == [first, None, None, None]


def test_wall_clock_does_not_depend_on_the_session_zone(spark):
    skipped = "04/07/1996 02:07:26 AM"  # an hour that does not exist in New York
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(skipped, "07/Apr/1996:02:07:26")], "call STRING, log STRING").select(
            clock.parse_call_moment(F.col("call")).alias("m"), clock.parse_log_stamp(F.col("log")).alias("l")
        )
        moment = datetime.datetime(1996, 4, 7, 2, 7, 26)
        row = df.select("m", "l", clock.call_text(F.col("m")), clock.log_text(F.col("l")), clock.compact_text(F.col("m")))
        assert tuple(row.first()) == (moment, moment, skipped, "07/Apr/1996:02:07:26", "04070207")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_bad_cast_raises_where_try_cast_gives_null(spark):
    with pytest.raises(PySparkException):
        spark.range(1).select(F.lit("abc").cast("int")).collect()
    assert spark.range(1).select(F.lit("abc").try_cast("int")).first()[0] is None


def test_log_lines_that_end_in_a_carriage_return(spark, tmp_path):
    line = 'host1.example.com - - [01/Jul/1995:00:00:01 -0400] "GET /a/b HTTP/1.0" 200 '
    path = tmp_path / "log.txt"
    path.write_bytes(f"{line}-\r\n{line}3000000000\r\n{line}17\n".encode())
    lines = readers.read_text(spark, str(path))
    assert all(not r.value.endswith("\r") for r in lines.collect())
    given = spark.createDataFrame([(f"{line}-\r",), (f"{line}3000000000\r",), (f"{line}17",)], "value string")
    for source in (lines, given):
        assert sorted(r.content_size for r in weblogs.requests(source).collect()) == [0, 17, 3_000_000_000]


def test_cubes_are_exact_beside_a_null(spark):
    rows = spark.createDataFrame([(300_007,), (None,), (-3,)], "n long").coalesce(1)
    assert [r[0] for r in rows.select(cube_batch("n")).collect()] == [300_007**3, None, -27]
    with pytest.raises(Exception, match="does not fit"):
        spark.createDataFrame([(2_097_152,), (None,)], "n long").select(cube_batch("n")).collect()


def test_separators_that_start_alike_have_copies_of_their_own(spark, sf_dir):
    one, two = (csv_copy(spark, sf_dir, "people", sep=sep) for sep in ("|", "||"))
    assert one != two
    assert readers.read_csv(spark, two, sep="||").count() == readers.read_csv(spark, one, sep="|").count()


#: The columns each sorted answer is ordered by, and whether they fall.
SORTED_KEYS = {
    "sort_desc": [("l_extendedprice", True), ("l_orderkey", False), ("l_linenumber", False), ("l_partkey", False)],
    "sort_multi": [("o_orderpriority", False), ("o_totalprice", True), ("o_orderkey", False)],
    "topk_limit": [("o_totalprice", True), ("o_orderkey", False)],
    "flights_q1": [("distance", True), ("origin", False), ("destination", False)],
    "flights_q3_case": [("origin", False), ("delay", True), ("destination", False)],
    "flights_q3_when": [("origin", False), ("delay", True), ("destination", False)],
    "flights_pivot": [("destination", False)],
    "fire_worst_2018": [("DelayMinutes", True)],
    "fire_common_types": [("count", True), ("CallType", False)],
    "fire_type_zip": [("count", True), ("CallType", False), ("Zipcode", False)],
    "fire_years": [("year", False)],
    "fire_week_2018": [("count", True), ("week", False)],
    "iot_low_battery": [("c02_level", False)],
    "nasa_q2": [("total", True), ("http_status", False)],
    "nasa_q3": [("total", True), ("request_method", False)],
}


@pytest.mark.parametrize("key", sorted(SORTED_KEYS))
def test_sorted_answers_are_sorted(key, spark, sf_dir):
    rows = [r.asDict() for r in all_queries()[key](spark, sf_dir).collect()]
    expected = rows
    for name, falling in reversed(SORTED_KEYS[key]):
        expected = sorted(expected, key=lambda r: r[name], reverse=falling)
    names = [name for name, _ in SORTED_KEYS[key]]
    assert [[r[n] for n in names] for r in rows] == [[r[n] for n in names] for r in expected] and len(rows) > 1


def test_roots_are_written_through_one_resource_a_partition(spark, tmp_path):
    path = str(tmp_path / "roots")
    write_roots(spark.range(20_000, numPartitions=3).selectExpr("id", "id * 3 AS square"), path)
    assert len(list((tmp_path / "roots").glob("part-*"))) == 3
    found = {r.id: r.root for r in spark.read.schema("id long, root double").csv(path).collect()}
    assert found == {i: math.sqrt(3 * i) for i in range(20_000)}
    write_roots(spark.range(0).selectExpr("id", "id AS square"), str(tmp_path / "none"))


def test_log_lines_vary(spark, sf_dir):
    found = weblogs.parsed(spark, sf_dir)
    assert found.select("protocol").distinct().count() >= 4
    assert found.select("request_method").distinct().count() >= 4
    assert found.select("http_status").distinct().count() >= 4


def test_default_stamps_take_unpadded_months_and_days(spark):
    texts = ["1995-7-1 0:0:1", "1995-07-01 00:00:01", "1995-7-1", "1995-13-1 0:0:1", "95-7-1", "", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(clock.parse_default(F.col("t")).cast("string")).collect()
    assert [r[0] for r in found] == ["1995-07-01 00:00:01"] * 2 + ["1995-07-01 00:00:00"] + [None] * 4


def test_call_moments_are_read_once_and_strictly(spark):
    texts = ["01/02/2018 12:00:00 AM", "01/02/2018 12:30:00 pm", "01/02/2018 01:00:09 PM", "02/30/2018 01:00:00 AM", "01/02/2018 13:00:00 PM", "1/2/2018 01:00:00 AM", "x", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(clock.parse_call_moment(F.col("t")).cast("string")).collect()
    assert [r[0] for r in found] == ["2018-01-02 00:00:00", "2018-01-02 12:30:00", "2018-01-02 13:00:09"] + [None] * 5
