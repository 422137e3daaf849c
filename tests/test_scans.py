"""Segmented scans and the interval join: the plain answers, with keys that hold most of the rows."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from sparkwell.operators import intervals, scans

ORDER = ("at", "id")


@pytest.fixture(scope="module")
def skewed_rows(spark):
    """One key with two thirds of the rows, a null key, null values, equal times."""
    chance = np.random.default_rng(6)
    keys = [None if i % 29 == 0 else int(7 if i % 3 else chance.integers(0, 40)) for i in range(3000)]
    rows = [(k, i, int(chance.integers(0, 300)), None if i % 11 == 0 else int(chance.integers(-50, 50)), f"t{i % 5}") for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "k long, id long, at int, v long, t string").repartition(5)


def test_frequent_keys_are_cut_evenly(skewed_rows):
    cut = scans.in_parts(skewed_rows, "k", ORDER, share=0.05)
    sizes = {(r.k, r.part): r["count"] for r in cut.groupBy("k", "part").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == 7]
    assert len(hot) > 8 and max(hot) < 3 * 0.05 * 3000
    assert {part for k, part in sizes if k not in (7, None)} == {0}
    ends = cut.filter("k = 7").groupBy("part").agg(F.min(F.struct(*ORDER)).alias("a"), F.max(F.struct(*ORDER)).alias("b")).orderBy("part").collect()
    assert all(x.b < y.a for x, y in zip(ends, ends[1:], strict=False))


@pytest.mark.parametrize("share", [None, 0.05, 0.002])
def test_running_values(skewed_rows, share):
    columns = {"c": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "f": ("first", "v"), "l": ("last", "v")}
    found = scans.running(skewed_rows, "k", ORDER, columns, share)
    w = Window.partitionBy("k").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    functions = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "first": lambda c: F.first(c, True), "last": lambda c: F.last(c, True)}
    wanted = skewed_rows.select("*", *[functions[how](c).over(w).alias(name) for name, (how, c) in columns.items()])
    assert rows_of(found) == rows_of(wanted)


@pytest.mark.parametrize("share", [None, 0.05, 0.002])
@pytest.mark.parametrize("before, after", [(3, 1), (0, 0), (0, 40), (75, 0)])
def test_sliding_frames(skewed_rows, share, before, after):
    """Frames wider than a part reach over several parts."""
    found = scans.sliding(skewed_rows, "k", ORDER, before, after, {"s": F.sum("v"), "n": F.count("*")}, share)
    w = Window.partitionBy("k").orderBy(*ORDER).rowsBetween(-before, after)
    assert rows_of(found) == rows_of(skewed_rows.select("*", F.sum("v").over(w).alias("s"), F.count("*").over(w).alias("n")))


@pytest.mark.parametrize("share", [None, 0.05, 0.002])
def test_neighbours(skewed_rows, share):
    found = scans.neighbours(skewed_rows, "k", ORDER, {"b": ("v", -1), "far": ("id", -30), "on": ("at", 2)}, share)
    w = Window.partitionBy("k").orderBy(*ORDER)
    assert rows_of(found) == rows_of(skewed_rows.select("*", F.lag("v").over(w).alias("b"), F.lag("id", 30).over(w).alias("far"), F.lead("at", 2).over(w).alias("on")))


@pytest.mark.parametrize("share", [None, 0.05])
@pytest.mark.parametrize("kind", ["rowsBetween", "rangeBetween"])
def test_first_and_last_over_the_whole_frame(skewed_rows, share, kind):
    found = scans.over_all(skewed_rows, "k", ORDER, {"f": ("first", "v"), "l": ("last", "t")}, share)
    order = ORDER if kind == "rowsBetween" else (F.struct(*ORDER),)
    w = getattr(Window.partitionBy("k").orderBy(*order), kind)(Window.unboundedPreceding, Window.unboundedFollowing)
    assert rows_of(found) == rows_of(skewed_rows.select("*", F.first("v").over(w).alias("f"), F.last("t").over(w).alias("l")))


def test_without_a_frequent_key_it_is_a_plain_window(spark):
    rows = spark.range(1000).selectExpr("id % 100 as k", "id", "id as at", "id as v")
    plan = plan_of(scans.running(rows, "k", ORDER, {"s": ("sum", "v")}))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def met_by_hand(left, right):
    return sorted((k, max(a, c), min(b, d), x, y) for k, a, b, x in left for k2, c, d, y in right if k == k2 and None not in (k, a, b, c, d) and a < d and c < b)


@pytest.mark.parametrize("per_bin", [1, 4, 10_000])
def test_overlapping_periods(spark, per_bin):
    """Periods of any kind: nested, equal, empty, turned round, without ends or keys."""
    chance = np.random.default_rng(7)

    def side(n, name):
        rows = []
        for i in range(n):
            a = int(chance.integers(0, 60))
            rows.append((int(chance.integers(0, 4)), a, a + int(chance.choice([0, 1, 2, 5, 40, -3])), f"{name}{i}"))
        return rows + [(None, 1, 2, f"{name}-"), (1, None, 5, f"{name}-"), (1, 2, None, f"{name}-")]

    left, right = side(120, "l"), side(90, "r")
    frames = [spark.createDataFrame(rows, f"k long, since int, until int, {c} string") for rows, c in ((left, "x"), (right, "y"))]
    found = intervals.overlapping(*frames, "k", per_bin=per_bin)
    assert sorted(map(tuple, found.collect())) == met_by_hand(left, right)


def test_a_history_of_a_hundred_thousand_periods(spark):
    """Two long histories of one employee meet in as many pairs as they have periods, in bins of bounded size."""
    n = 100_000
    rows = spark.range(n).selectExpr("if(id < 0, 2L, 1L) as k", "id", "cast(id * 7 as int) as at", "id as x")
    other = spark.range(n // 3).selectExpr("if(id < 0, 2L, 1L) as k", "id", "cast(id * 20 + 3 as int) as at", "id as y")
    left = intervals.periods(rows, "k", "at", ("at", "id"), "x", share=0.05).fillna(10**9, ["until"])
    right = intervals.periods(other, "k", "at", ("at", "id"), "y", share=0.05).fillna(10**9, ["until"])
    found = intervals.overlapping(left, right, "k", share=0.05)
    a, b = np.append(np.arange(n) * 7, 10**9), np.append(np.arange(n // 3) * 20 + 3, 10**9)
    wanted = int((np.searchsorted(b[:-1], a[1:]) - np.searchsorted(b[1:], a[:-1], side="right")).sum())
    assert found.count() == wanted < 1.5 * n
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_bins_hold_a_bounded_number_of_beginnings(spark):
    rows = spark.range(5000).selectExpr("id % 2 as k", "cast(id as int) as since", "cast(id + 2 as int) as until", "id as x")
    bins = rows.groupBy("k", F.col("since").alias("time")).agg(F.count("*").alias("begins"))
    counted = scans.running(bins, "k", ("time",), {"so_far": ("sum", "begins")}, 0.05).selectExpr("k as key", "time", "floor((so_far - begins) / 64) as bin")
    ends = rows.selectExpr("k as key", "until as time").subtract(counted.select("key", "time")).withColumn("bin", F.lit(39).cast("long"))
    placed = intervals._binned(rows, counted.unionByName(ends), "k")
    sizes = Counter({(r.k, r.bin): r["count"] for r in placed.groupBy("k", "bin").count().collect()})
    assert max(sizes.values()) <= 64 + 2


def test_periods_join_equal_records(spark):
    rows = [(1, 1, 10, "a"), (1, 2, 20, "a"), (1, 3, 30, None), (1, 4, 40, None), (1, 5, 50, "a"), (2, 6, 5, "b")]
    history = spark.createDataFrame(rows, "k long, id long, at int, v string")
    found = intervals.periods(history, "k", "at", ("at", "id"), "v", only_changes=True)
    assert rows_of(found) == sorted([(1, 10, 30, "a"), (1, 30, 50, None), (1, 50, None, "a"), (2, 5, None, "b")], key=repr)


@pytest.mark.parametrize("per_bin", [20, 10_000])
def test_only_keys_with_more_periods_than_a_bin_are_cut_into_bins(spark, per_bin, monkeypatch):
    """Key 1 has 40 periods a side, all others have 8 at most."""
    rows = [(1, i, i + 3) for i in range(40)] + [(k, i, i + k % 4) for k in range(2, 30) for i in range(4)]
    binned = []
    whole = intervals._binned
    monkeypatch.setattr(intervals, "_binned", lambda side, *rest: binned.append({r.k for r in side.select("k").distinct().collect()}) or whole(side, *rest))
    left, right = (spark.createDataFrame([(*row, f"{c}{n}") for n, row in enumerate(rows)], f"k long, since int, until int, {c} string") for c in "xy")
    found = intervals.overlapping(left, right, "k", per_bin=per_bin)
    assert sorted(map(tuple, found.collect())) == met_by_hand(*([(*row, f"{c}{n}") for n, row in enumerate(rows)] for c in "xy"))
    assert binned == ([{1}, {1}] if per_bin == 20 else [])
