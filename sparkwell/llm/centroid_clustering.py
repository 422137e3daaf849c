"""Exact k-means on integer vectors by Shallot search.

Components are scaled and floored to integers; centroids are integers too, so every
distance that decides is an exact integer. Each vector remembers its nearest and its
second-nearest centroid with an upper bound on the distance to the first and a lower bound
on that to all others. Bounds move with the centroids; a vector whose bounds can't meet
stays without any distance. The others start from the closer of their two remembered
centroids and walk its neighbours in order of distance, as far as a ball reaches whose
radius (distance to the start plus distance to the second nearest so far) shrinks with
every better centroid found. What survives is compared in integers.

A round is one pass over the vectors: it writes their new state and, a few rows a task, the
sums of each cluster, which Spark adds up. The driver holds only the k centroids. The state
of the round before is deleted once the new one is written.

Defined results: vectors that are null, of another length or hold null or non-finite components are
left out; a null id counts as empty text in the choice of starts; each row is a vector of its own, repeated
rows included, and starts with equal hashes are ordered by their components; with fewer vectors than k
there are as many centroids as vectors; without vectors the answer is empty; a distance or sum that
doesn't fit in a long is null, while clusters stay exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparkwell.llm.vectors import matrix
from sparkwell.storage import delete, new_path

#: Below this magnitude squared distances of a few hundred components fit in 64 bits.
NARROW = 1 << 26
#: Bounds are floating-point numbers; they only ever rule a centroid out by more than this share.
SLACK = 1e-9
LIMB = 40
LONGEST = (1 << 63) - 1


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as 64-bit integers or, where those may overflow, as Python's."""
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * vectors)
    if not scaled.size or np.abs(scaled).max() < NARROW:
        return scaled.astype(np.int64)
    whole = [int(s) if np.isfinite(s) else scale * int(x) for s, x in zip(scaled.ravel().tolist(), vectors.ravel().tolist(), strict=True)]
    made = np.empty(len(whole), object)
    made[:] = whole
    return made.reshape(vectors.shape)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((x - c) ** 2).sum(axis=-1)


@dataclass
class Centroids:
    """Where the centroids are and how far each has moved in the last round."""

    at: list[list[int]]
    moved: np.ndarray

    def __post_init__(self):
        wide = any(abs(v) >= NARROW for row in self.at for v in row)
        self.points = np.array(self.at, object if wide else np.int64)
        if not wide:
            self.gap = np.sqrt(squared(self.points[:, None], self.points[None]).astype(float))
            self.near = np.argsort(self.gap, axis=1, kind="stable")

    @classmethod
    def first(cls, at: list[list[int]]) -> Centroids:
        return cls(at, np.zeros(len(at)))

    def after(self, totals: dict[int, tuple[int, list[int]]]) -> Centroids:
        """Every centroid with vectors at the floor of their mean; the others stay."""
        new = [[s // totals[c][0] for s in totals[c][1]] if c in totals else row for c, row in enumerate(self.at)]
        far = [sum((p - q) ** 2 for p, q in zip(a, b, strict=True)) for a, b in zip(self.at, new, strict=True)]
        return Centroids(new, np.array([float(min(d, 1 << 1000)) ** 0.5 for d in far]) * (1 + SLACK))

    def digest(self, c: int) -> str:
        return hashlib.sha256(",".join(map(str, self.at[c])).encode()).hexdigest()


@dataclass
class Memory:
    """What each vector remembers: nearest and second-nearest centroid, and the bounds."""

    first: np.ndarray
    second: np.ndarray
    upper: np.ndarray
    lower: np.ndarray

    @classmethod
    def none(cls, n: int) -> Memory:
        return cls(np.zeros(n, np.int32), np.ones(n, np.int32), np.full(n, np.inf), np.zeros(n))


def assign(x: np.ndarray, centroids: Centroids, known: Memory) -> Memory:
    """Nearest (ties: the smaller number) and second-nearest centroid of each vector."""
    k = len(centroids.at)
    if k == 1:
        return Memory(np.zeros(len(x), np.int32), np.zeros(len(x), np.int32), np.full(len(x), np.inf), np.full(len(x), np.inf))
    if x.dtype == object or centroids.points.dtype == object:
        best = [min((sum((p - q) ** 2 for p, q in zip(row, c, strict=True)), j) for j, c in enumerate(centroids.at))[1] for row in x.tolist()]
        forgotten = Memory.none(len(x))
        return Memory(np.array(best, np.int32), np.where(np.array(best) == 0, 1, 0).astype(np.int32), forgotten.upper, forgotten.lower)
    first, second = known.first.copy(), known.second.copy()
    most = np.argmax(centroids.moved)
    others = np.where(first == most, np.delete(centroids.moved, most).max(), centroids.moved[most])
    upper, lower = known.upper + centroids.moved[first], known.lower - others
    rows = np.flatnonzero(upper >= lower * (1 - SLACK))
    near = squared(x[rows], centroids.points[first[rows]])
    upper[rows] = np.sqrt(near)
    unsure = upper[rows] >= lower[rows] * (1 - SLACK)
    rows, near = rows[unsure], near[unsure]
    a, b = first[rows], second[rows]
    next_near = squared(x[rows], centroids.points[b])
    swap = (next_near < near) | ((next_near == near) & (b < a))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    near, next_near = np.where(swap, next_near, near), np.where(swap, near, next_near)
    start, beside, reach = a.copy(), b.copy(), np.sqrt(near)
    open_ = np.arange(len(rows))
    for step in range(k):  # equal centroids have gap 0, so the start need not be the first of its neighbours
        c = centroids.near[start[open_], step]
        inside = centroids.gap[start[open_], c] <= (reach[open_] + np.sqrt(next_near[open_])) * (1 + SLACK)
        open_, c = open_[inside], c[inside]
        if not len(open_):
            break
        new = (c != beside[open_]) & (c != start[open_])
        at, c = open_[new], c[new].astype(np.int32)
        d = squared(x[rows[at]], centroids.points[c])
        better = (d < near[at]) | ((d == near[at]) & (c < a[at]))
        up, into = at[better], at[~better]
        b[up], next_near[up] = a[up], near[up]
        a[up], near[up] = c[better], d[better]
        closer = d[~better] < next_near[into]
        b[into[closer]], next_near[into[closer]] = c[~better][closer], d[~better][closer]
    first[rows], second[rows], upper[rows], lower[rows] = a, b, np.sqrt(near), np.sqrt(next_near)
    return Memory(first, second, upper, lower)


def kept(rows: DataFrame, vector: str, dims: int) -> DataFrame:
    """The rows whose vector has ``dims`` components, none null or non-finite."""
    sound = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col(vector).isNotNull() & (F.size(vector) == dims) & F.coalesce(sound, F.lit(False)))


def starts(rows: DataFrame, id_col: str, vector: str, k: int, scale: int) -> list[list[int]]:
    """The integer vectors of the k rows with the smallest hash of their id."""
    hashed = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    first = rows.select(hashed.alias("hash"), F.col(vector).cast("array<double>").alias("v")).orderBy("hash", "v").limit(k).collect()
    return [[int(v) for v in integers(np.array([r["v"]], float), scale)[0].tolist()] for r in first]


def _limbs(value: int, places: int) -> list[int]:
    sign, value = (-1, -value) if value < 0 else (1, value)
    return [sign * ((value >> (LIMB * i)) & ((1 << LIMB) - 1)) for i in range(places)]


def _round(source: DataFrame, centroids: Centroids, scale: int, first: bool, last: bool) -> DataFrame:
    """The state of each vector after one assignment, and rows of cluster sums (those with a ``limb``); the last round has distances instead."""
    sent = source.sparkSession.sparkContext.broadcast(centroids)
    extra = {"a": "int", "b": "int", "upper": "double", "lower": "double", "distance": "long", "limb": "int", "members": "long", "sums": "array<bigint>"}
    shape = T.StructType([T.StructField(f.name, f.dataType) for f in source.select("id", "v").schema])
    for name, kind in extra.items():
        shape = shape.add(name, T.DataType.fromDDL(kind))
    arrow = to_arrow_schema(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        k, members, sums = len(c.at), np.zeros(len(c.at), np.int64), None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            x = integers(matrix(batch.column(1)), scale)
            column = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            known = Memory.none(n) if first else Memory(*map(column, ("a", "b", "upper", "lower")))
            found = assign(x, c, known)
            distance = [None] * n
            if last:
                distance = [d if d <= LONGEST else None for d in squared(x, c.points[found.first]).tolist()]
            else:
                sums = np.zeros((k, x.shape[1]), object) if sums is None else sums
                for j in np.unique(found.first).tolist():
                    mine = x[found.first == j]
                    members[j] += len(mine)
                    sums[j] += np.array([int(s) for s in mine.sum(axis=0).tolist()], object)
            values = [batch.column(0), batch.column(1), found.first, found.second, found.upper, found.lower, distance, [None] * n, [None] * n, [None] * n]
            yield _batch(values, arrow)
        rows = []
        for j in np.flatnonzero(members).tolist():
            places = max(1, max(-(-int(abs(s)).bit_length() // LIMB) for s in sums[j]))
            cut = [_limbs(int(s), places) for s in sums[j]]
            rows += [(j, limb, int(members[j]) if limb == 0 else 0, [part[limb] for part in cut]) for limb in range(places)]
        if rows:
            a, limb, count, parts = zip(*rows, strict=True)
            none = [None] * len(rows)
            yield _batch([none, none, list(a), none, none, none, none, list(limb), list(count), list(parts)], arrow)

    return source.mapInArrow(run, shape)


def _batch(values: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = [v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(values, schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


def _totals(state: DataFrame, dims: int) -> dict[int, tuple[int, list[int]]]:
    """(members, component sums) of each cluster that has vectors: k rows for each limb."""
    parts = state.filter("limb is not null").groupBy("a", "limb")
    each = parts.agg(F.sum("members").alias("members"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(dims)]).collect()
    found: dict[int, tuple[int, list[int]]] = {}
    for r in each:
        n, sums = found.get(r["a"], (0, [0] * dims))
        found[r["a"]] = (n + r["members"], [s + (r[f"s{i}"] << (LIMB * r["limb"])) for i, s in enumerate(sums)])
    return found


def cluster(rows: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of ``dims`` sound components.

    ``rounds`` times all vectors are assigned and the centroids moved; then they are assigned once more.
    """
    spark = rows.sparkSession
    source = kept(rows.select(F.col(id_col).alias("id"), F.col(vector).alias("v")), "v", dims)
    chosen = starts(source, "id", "v", k, scale)
    if not chosen:
        schema = T.StructType([T.StructField(id_col, rows.schema[id_col].dataType)])
        for name, kind in {"cluster": "int", **dict.fromkeys(("distance", "cluster_inertia", "inertia"), "long"), "centroid_sha256": "string"}.items():
            schema = schema.add(name, T.DataType.fromDDL(kind))
        return spark.createDataFrame([], schema)
    centroids, path = Centroids.first(chosen), None
    for turn in range(rounds + 1):
        new = new_path(spark, "clusters")
        made = _round(source, centroids, scale, path is None, turn == rounds)
        made.write.parquet(new)
        state = spark.read.schema(made.schema).parquet(new)
        if path is not None:
            delete(spark, path)
        path, source = new, state.filter("limb is null")
        if turn < rounds:
            centroids = centroids.after(_totals(state, dims))
    fits = F.count("distance") == F.count("*")
    sums = {r["a"]: r["inertia"] for r in source.groupBy("a").agg(F.when(fits, F.try_sum("distance")).alias("inertia")).collect()}
    whole = None if None in sums.values() or sum(sums.values()) > LONGEST else sum(sums.values())
    told = [(c, s, centroids.digest(c)) for c, s in sums.items()]
    each = F.broadcast(spark.createDataFrame(told, "a int, cluster_inertia long, centroid_sha256 string"))
    return source.join(each, "a").select(
        F.col("id").alias(id_col), F.col("a").alias("cluster"), "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid_sha256"
    )
