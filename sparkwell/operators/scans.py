"""Window frames over rows, as a segmented scan.

A window puts all rows of a key into one task. Here a key with more rows than a partition
should hold is cut along its order into parts, as many as it fills partitions; the cuts come from a
bounded sample and only decide the balance. Each part is scanned by an ordinary window. What a frame needs
from other parts is carried over: for frames without bound a few values a part, for frames of a few rows
copies of the rows at the parts' edges. Without a frequent key this is the plain window.

Rows are ordered by ``order`` (nulls first), whose last column should tell rows apart; null is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwell import views
from sparkwell.registry import query
from sparkwell.skew import hot_keys

#: Sampled rows for each part that a frequent key is cut into.
SAMPLED = 64


def _place(order: Sequence[str]) -> Column:
    return F.struct(*order)


def in_parts(rows: DataFrame, key: str, order: Sequence[str], share: float | None = None) -> DataFrame:
    """``rows`` with ``part``: 0 for most keys, else which stretch of its key's order a row lies in.

    Cuts go to every task as literals; all keys together have fewer than two for each partition.
    """
    hot = [(value, parts) for value, parts in hot_keys(rows, key, share) if parts > 1]
    if not hot:
        return rows.withColumn("part", F.lit(0))
    of_hot = F.col(key).isin([value for value, _ in hot if value is not None])
    if any(value is None for value, _ in hot):
        of_hot = F.col(key).isNull() | of_hot
    wanted = SAMPLED * sum(parts for _, parts in hot)
    drawn = rows.filter(of_hot).select(key, _place(order).alias("place")).orderBy(F.xxhash64("place", key)).limit(wanted)
    kind = dict(rows.select(_place(order).alias("place")).dtypes)["place"]
    sample: dict[object, list] = {}
    for r in drawn.orderBy("place").collect():
        sample.setdefault(r[key], []).append(r["place"])
    part = F.lit(0)
    for value, parts in hot:
        places = sample.get(value, [])
        cuts = sorted({len(places) * i // parts for i in range(1, parts)}) if places else []
        bounds = [F.struct(*[F.lit(x) for x in places[i]]).cast(kind) for i in cuts]
        if bounds:
            passed = F.size(F.filter(F.array(*bounds), lambda cut: cut <= _place(order)))
            part = F.when(F.col(key).eqNullSafe(F.lit(value)), passed).otherwise(part)
    return rows.withColumn("part", part.cast("int"))


def _parts(cut: DataFrame, key: str, sums: Sequence[Column]) -> DataFrame:
    """A row for each part of the keys that have several; few, as only frequent keys are cut."""
    each = cut.filter("part > 0").select(key).distinct().withColumnRenamed(key, "key_of_part")
    several = cut.join(F.broadcast(each), F.col(key).eqNullSafe(F.col("key_of_part")), "left_semi")
    return several.groupBy(F.col(key).alias("key_of_part"), F.col("part").alias("part_of_key")).agg(*sums)


def _carried(rows: DataFrame, carries: DataFrame, key: str, kind: str = "left") -> DataFrame:
    same = F.col(key).eqNullSafe(F.col("key_of_part")) & (F.col("part") == F.col("part_of_key"))
    return rows.join(F.broadcast(carries), same, kind).drop("key_of_part", "part_of_key")


def running(rows: DataFrame, key: str, order: Sequence[str], columns: dict[str, tuple[str, str]], share: float | None = None) -> DataFrame:
    """``rows`` with running values from the key's first row to each row.

    ``columns`` names each new column with its function (``count``, ``sum``, ``min``, ``max``, ``first`` or ``last``, nulls left out) and its source.
    """
    cut = in_parts(rows, key, order, share)
    total = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    inside = Window.partitionBy(key, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("key_of_part").orderBy("part_of_key").rowsBetween(Window.unboundedPreceding, -1)
    own, sums, carry, joined = {}, [], [], {}
    for name, (how, source) in columns.items():
        value, mine, theirs = F.col(source), F.col(f"{name}_in_part"), F.col(f"{name}_before")
        if how in total:
            own[name], whole = total[how](value).over(inside), total[how](value)
            ahead = (F.sum if how == "count" else total[how])(f"{name}_of_part").over(before)
        else:
            function, best = (F.first, F.min_by) if how == "first" else (F.last, F.max_by)
            own[name] = function(value, ignorenulls=True).over(inside)
            whole = best(value, F.when(value.isNotNull(), _place(order)))
            ahead = function(f"{name}_of_part", ignorenulls=True).over(before)
        sums.append(whole.alias(f"{name}_of_part"))
        carry.append(ahead.alias(f"{name}_before"))
        joined[name] = {
            "count": mine + F.coalesce(theirs, F.lit(0)),
            "sum": F.coalesce(mine + theirs, mine, theirs),
            "min": F.least(mine, theirs),
            "max": F.greatest(mine, theirs),
            "first": F.coalesce(theirs, mine),
            "last": F.coalesce(mine, theirs),
        }[how]
    scanned = cut.withColumns({f"{name}_in_part": value for name, value in own.items()})
    carries = _parts(cut, key, sums).select("key_of_part", "part_of_key", *carry)
    return _carried(scanned, carries, key).select(*rows.columns, *(value.alias(name) for name, value in joined.items()))


def over_all(rows: DataFrame, key: str, order: Sequence[str], columns: dict[str, tuple[str, str]], share: float | None = None) -> DataFrame:
    """``rows`` with the ``first`` or ``last`` value of their key's order, nulls included: frames from the first row to the last."""
    cut = in_parts(rows, key, order, share)
    inside = Window.partitionBy(key, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = Window.partitionBy("key_of_part").orderBy("part_of_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    functions = {"first": (F.first, F.min_by), "last": (F.last, F.max_by)}
    scanned = cut.withColumns({f"{name}_in_part": functions[how][0](source).over(inside) for name, (how, source) in columns.items()})
    ends = _parts(cut, key, [functions[how][1](F.struct(source), _place(order)).alias(name) for name, (how, source) in columns.items()])
    carries = ends.select("key_of_part", "part_of_key", *[functions[how][0](name).over(whole).alias(f"{name}_of_key") for name, (how, _) in columns.items()])
    told = {
        name: F.when(F.col(f"{name}_of_key").isNotNull(), F.col(f"{name}_of_key")[source]).otherwise(F.col(f"{name}_in_part"))
        for name, (_, source) in columns.items()
    }
    return _carried(scanned, carries, key).select(*rows.columns, *(value.alias(name) for name, value in told.items()))


def _with_edges(rows: DataFrame, key: str, order: Sequence[str], before: int, after: int, share: float | None) -> DataFrame:
    """``rows`` in parts, with copies (``copied``) in each part of the rows that its frames need from other parts of the key."""
    cut = in_parts(rows, key, order, share)
    inside = Window.partitionBy(key, "part").orderBy(*order)
    ahead = Window.partitionBy("key_of_part").orderBy("part_of_key").rowsBetween(Window.unboundedPreceding, -1)
    bounds = _parts(cut, key, [F.count("*").alias("size")]).withColumn("skipped", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    numbered = _carried(cut.withColumn("in_part", F.row_number().over(inside)), bounds, key, "inner")
    # A row further than this from its own part's edge is too far from any other part.
    edge = (F.col("in_part") <= before + after) | (F.col("in_part") > F.col("size") - (before + after))
    near = numbered.filter(edge).select(*rows.columns, F.col("part").alias("own_part"), (F.col("in_part") + F.col("skipped")).alias("spot"))
    reach = (F.col("spot") > F.col("skipped") - before) & (F.col("spot") <= F.col("skipped") + F.col("size") + after)
    others = F.col(key).eqNullSafe(F.col("key_of_part")) & (F.col("own_part") != F.col("part_of_key")) & reach
    copies = near.join(F.broadcast(bounds), others).select(*rows.columns, F.col("part_of_key").alias("part"), F.lit(True).alias("copied"))
    return cut.select(*rows.columns, "part", F.lit(False).alias("copied")).unionByName(copies)


def sliding(rows: DataFrame, key: str, order: Sequence[str], before: int, after: int, columns: dict[str, Column], share: float | None = None) -> DataFrame:
    """``rows`` with aggregates over ROWS BETWEEN ``before`` PRECEDING AND ``after`` FOLLOWING."""
    frame = Window.partitionBy(key, "part").orderBy(*order).rowsBetween(-before, after)
    both = _with_edges(rows, key, order, before, after, share)
    return both.withColumns({name: value.over(frame) for name, value in columns.items()}).filter("not copied").select(*rows.columns, *columns)


def neighbours(rows: DataFrame, key: str, order: Sequence[str], columns: dict[str, tuple[str, int]], share: float | None = None) -> DataFrame:
    """``rows`` with values of earlier (negative distance) or later rows of their key, null beyond its ends.

    ``columns`` names each new column with its source and the distance.
    """
    before, after = max([0, *(-d for _, d in columns.values())]), max([0, *(d for _, d in columns.values())])
    inside = Window.partitionBy(key, "part").orderBy(*order)
    both = _with_edges(rows, key, order, before, after, share)
    return both.withColumns({name: F.lead(source, d).over(inside) for name, (source, d) in columns.items()}).filter("not copied").select(*rows.columns, *columns)


_CENTS = "CAST(round(salary * 100) AS BIGINT)"
_ORDERED = "(PARTITION BY emp_no ORDER BY to_date, id"


def _paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.salaries(spark, sf_dir).withColumn("cents", F.round(F.col("salary") * 100).cast("long"))


@query(
    "win_running_rows",
    f"""SELECT emp_no, id, count(*) OVER w AS nth, CAST(sum({_CENTS}) OVER w AS BIGINT) AS paid_so_far, max({_CENTS}) OVER w AS most_so_far,
               first_value({_CENTS}) OVER w AS first_cents
        FROM v_salaries WINDOW w AS {_ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def win_running_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"nth": ("count", "id"), "paid_so_far": ("sum", "cents"), "most_so_far": ("max", "cents"), "first_cents": ("first", "cents")}
    return running(_paid(spark, sf_dir), "emp_no", ("to_date", "id"), columns).select("emp_no", "id", *columns)


@query(
    "win_frame_rows",
    f"""SELECT emp_no, id, CAST(sum({_CENTS}) OVER w AS BIGINT) AS around, count(*) OVER w AS rows_around,
               lag(id) OVER v AS id_before, lead(id, 2) OVER v AS id_two_on
        FROM v_salaries WINDOW w AS {_ORDERED} ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING), v AS {_ORDERED})""",
)
def win_frame_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ("to_date", "id")
    summed = sliding(_paid(spark, sf_dir), "emp_no", order, 3, 1, {"around": F.sum("cents"), "rows_around": F.count("*")})
    placed = neighbours(summed, "emp_no", order, {"id_before": ("id", -1), "id_two_on": ("id", 2)})
    return placed.select("emp_no", "id", "around", "rows_around", "id_before", "id_two_on")


@query(
    "win_frame_last_value",
    f"""SELECT emp_no, id, salary, last_value(salary) OVER w AS last_salary, first_value(salary) OVER w AS first_salary
        FROM v_salaries WINDOW w AS {_ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def win_frame_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"last_salary": ("last", "salary"), "first_salary": ("first", "salary")}
    return over_all(views.salaries(spark, sf_dir), "emp_no", ("to_date", "id"), columns).select("emp_no", "id", "salary", *columns)
