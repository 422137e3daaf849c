"""Histories as periods, and the join of periods that overlap in time.

Two periods meet if each begins before the other ends. Compared pair by pair, a long history
would meet another one squared. Keys with no more periods than a bin may hold are compared that way;
the time of every other key is cut into bins with about equally many beginnings, found by a running
count over its times (a segmented scan, so a key of any length is spread). A period goes to every bin
it touches, periods meet by key and bin, and a pair counts in the bin where the later of the two begins,
which both touch. A bin holds a bounded number of beginnings and what runs through it, so no task gets
a whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell import storage, views
from sparkwell.operators.scans import neighbours, running
from sparkwell.registry import query
from sparkwell.skew import broadcast_if_small

#: Beginnings in a bin, and periods of a key that needs none.
BIN = 64


def periods(history: DataFrame, key: str, at: str, order: Sequence[str], value: str, only_changes: bool = False, share: float | None = None) -> DataFrame:
    """(key, since, until, value): each record counts from its date to that of the key's next record; the last one has no end.

    With ``only_changes`` records that repeat the value of the record before are part of its period.
    """
    history = history.select(key, *dict.fromkeys([at, *order, value]))
    if only_changes:
        first = neighbours(history.withColumn("here", F.lit(True)), key, order, {"value_before": (value, -1), "before": ("here", -1)}, share)
        changes = first.filter(F.col("before").isNull() | ~F.col("value_before").eqNullSafe(F.col(value))).select(history.columns)
        history = storage.written(changes, "changes")  # what follows reads it twice
    ended = neighbours(history, key, order, {"until": (at, 1)}, share)
    return ended.select(key, F.col(at).alias("since"), "until", value)


def _binned(side: DataFrame, bins: DataFrame, key: str) -> DataFrame:
    """A row for each bin that a period touches, with the bin it begins in. Times spread a long history over many tasks."""
    begin = bins.select(F.col("key").alias(key), F.col("time").alias("since"), F.col("bin").alias("first_bin"))
    end = bins.select(F.col("key").alias(key), F.col("time").alias("until"), F.col("bin").alias("last_bin"))
    placed = side.join(begin, [key, "since"]).join(end, [key, "until"])
    return placed.withColumn("bin", F.explode(F.sequence("first_bin", F.greatest("first_bin", "last_bin"))))


def overlapping(left: DataFrame, right: DataFrame, key: str, per_bin: int = BIN, share: float | None = None) -> DataFrame:
    """Pairs of periods (key, since, until, ...) of a key that overlap, with what they have in common as ``since`` and ``until``.

    Rows whose key, begin or end is null meet nothing. Other columns need different names on both sides.
    """
    sound = F.col(key).isNotNull() & F.col("since").isNotNull() & F.col("until").isNotNull()
    left, right = left.filter(sound), right.filter(sound)
    each = left.select(key).unionAll(right.select(key)).groupBy(key).count()
    crowded = storage.written(each.filter(F.col("count") > per_bin).select(key), "crowded-keys")
    if crowded.isEmpty():
        return _meeting(left, right, [key])
    some = broadcast_if_small(crowded)
    few = _meeting(*(side.join(some, key, "left_anti") for side in (left, right)), [key])
    return few.unionByName(_meeting_in_bins(*(side.join(some, key, "left_semi") for side in (left, right)), key, per_bin, share))


def _meeting(left: DataFrame, right: DataFrame, same: Sequence[str], *own: str) -> DataFrame:
    """Pairs that agree in ``same`` and overlap, by comparing all that agree; columns in ``own`` are told apart by side."""
    twice = ("since", "until", *own)
    a, b = (side.withColumnsRenamed({c: f"{c}_{name}" for c in twice}) for side, name in ((left, "left"), (right, "right")))
    met = a.join(b, list(same)).filter((F.col("since_left") < F.col("until_right")) & (F.col("since_right") < F.col("until_left")))
    both = met.withColumns({"since": F.greatest("since_left", "since_right"), "until": F.least("until_left", "until_right")})
    rest = [c for c in [*left.columns, *right.columns] if c not in (*same, *twice)]
    return both.select(*same, "since", "until", *rest, *(f"{c}_{name}" for c in own for name in ("left", "right")))


def _meeting_in_bins(left: DataFrame, right: DataFrame, key: str, per_bin: int, share: float | None) -> DataFrame:
    times = None
    for side in (left, right):
        for column, begins in (("since", 1), ("until", 0)):
            some = side.select(F.col(key).alias("key"), F.col(column).alias("time"), F.lit(begins).alias("begins"))
            times = some if times is None else times.unionByName(some)
    each = times.groupBy("key", "time").agg(F.sum("begins").alias("begins"))
    counted = running(each, "key", ("time",), {"so_far": ("sum", "begins")}, share)
    numbered = counted.select("key", "time", F.floor((F.col("so_far") - F.col("begins")) / per_bin).alias("bin"))
    bins = storage.written(numbered, "time-bins")
    met = _meeting(_binned(left, bins, key), _binned(right, bins, key), [key, "bin"], "first_bin", "last_bin")
    told = met.filter(F.col("bin") == F.greatest("first_bin_left", "first_bin_right"))
    return told.drop("bin", *(f"{c}_{name}" for c in ("first_bin", "last_bin") for name in ("left", "right")))


_PERIODS = """
    SELECT emp_no, to_date AS since, coalesce(lead(to_date) OVER (PARTITION BY emp_no ORDER BY to_date, id), TIMESTAMP '9999-01-01') AS until, {value}
    FROM {source}"""


def _changes(source: str, value: str) -> str:
    changed = f"SELECT * FROM {source} QUALIFY lag({value}) OVER (PARTITION BY emp_no ORDER BY to_date, id) IS DISTINCT FROM {value}"
    return _PERIODS.format(value=value, source=f"({changed})")


_MET = f"""
    SELECT s.emp_no, greatest(s.since, t.since) AS since, least(s.until, t.until) AS until, salary, title
    FROM ({_PERIODS.format(value="salary", source="v_salaries")}) s JOIN ({_changes("v_titles", "title")}) t
    ON s.emp_no = t.emp_no AND s.since < t.until AND t.since < s.until"""


@query(
    "join_overlapping",
    f"""SELECT a.emp_no, strftime(greatest(a.since, d.since), '%Y-%m-%d') AS since, strftime(least(a.until, d.until), '%Y-%m-%d') AS until,
               salary, title, dept_no
        FROM ({_MET}) a JOIN ({_changes("v_dept_emp", "dept_no")}) d ON a.emp_no = d.emp_no AND a.since < d.until AND d.since < a.until""",
)
def join_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each employee earned as what and where: three histories whose periods begin and end at times of their own."""
    open_end = F.to_timestamp_ntz(F.lit("9999-01-01"))

    def told(history: DataFrame, value: str, only_changes: bool) -> DataFrame:
        cut = periods(history, "emp_no", "to_date", ("to_date", "id"), value, only_changes)
        return storage.written(cut.withColumn("until", F.coalesce("until", open_end)), f"{value}-periods")

    salaries = told(views.salaries(spark, sf_dir), "salary", False)
    titles = told(views.titles(spark, sf_dir), "title", True)
    departments = told(views.dept_emp(spark, sf_dir), "dept_no", True)
    both = storage.written(overlapping(salaries, titles, "emp_no"), "overlapping")
    met = overlapping(both, departments, "emp_no")
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return met.select("emp_no", day("since"), day("until"), "salary", "title", "dept_no")
