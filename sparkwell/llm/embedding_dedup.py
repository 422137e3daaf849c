"""Embedding near-dedup by counting collisions of one-dimensional projections.

Unit vectors u, v with cosine c differ in a random projection by a normal value of deviation
sqrt(2 - 2c). On each of ``PROJECTIONS`` projections a window around the one vector's
value catches the other; a pair at the wanted cosine is caught in a known share of the
projections, so the number of collisions that a pair must reach is set from the binomial
distribution for a wanted recall. Pairs that reach it are verified by cosine in double precision.

To meet at all, vectors are sorted into cells: a band is a few of the projections, each cut
into strips with a random offset. The number of projections in a band grows with the
logarithm of the number of vectors, so that a cell holds about ``cell_rows`` unrelated vectors
at any size, and the number of bands follows from the recall. A cell of many is compared
in tiles of bounded size. Pairs never leave a task: a tile sends on how many links each vector has and
a tree of links for each group. A pair counts in the first band where it meets.

Equal vectors are one entry with a count. Defined results: a vector that is null, zero, or holds
null or non-finite components links with nothing; vectors of different length don't link; each row gets its own answer, also if
rows repeat or share an id; a group without any id has a null component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.shared import components, group_starts, mix, stored, whole_groups
from sparkwell.llm.vectors import digest, matrix, usable
from sparkwell.session import shuffle_partitions

PROJECTIONS = 64
TILE = 512
#: Width of a strip, and projections per unit in bytes.
STRIP, SCALE = 2.0, 20


def _caught(deviation: float, half_width: float) -> float:
    """The chance that a normal value lies within the window."""
    return math.erf(half_width / deviation / math.sqrt(2))


def _same_strip(deviation: float) -> float:
    """The chance that two values that differ by a normal value fall into one strip with a random offset."""
    x = STRIP / deviation
    return math.erf(x / math.sqrt(2)) - math.sqrt(2 / math.pi) / x * (1 - math.exp(-x * x / 2))


@dataclass
class Plan:
    """Projections, bands and the number of collisions, for vectors of one length."""

    cosine: float
    n: int
    recall: float
    cell_rows: int
    seed: int = 5

    def __post_init__(self) -> None:
        near, far = math.sqrt(2 - 2 * self.cosine), math.sqrt(2)
        meet, stray = _same_strip(near), _same_strip(far)
        self.depth = max(1, min(PROJECTIONS, round(math.log(max(self.n / self.cell_rows, 1)) / -math.log(stray))))
        missed = 1 - meet**self.depth
        self.bands = max(1, math.ceil(math.log(1 - self.recall) / math.log(missed))) if missed > 0 else 1
        self.reach = math.ceil(near * SCALE) + 1
        caught, chance, self.least = _caught(near, near), 0.0, 0
        # The largest number of collisions that a pair at the wanted cosine fails with a chance of 1e-6 at most.
        while True:
            chance += math.comb(PROJECTIONS, self.least) * caught**self.least * (1 - caught) ** (PROJECTIONS - self.least)
            if chance > 1e-6:
                break
            self.least += 1

    def directions(self, size: int) -> np.ndarray:
        return np.random.default_rng((self.seed, size)).standard_normal((size, PROJECTIONS))

    def cells(self, projected: np.ndarray) -> np.ndarray:
        """A key for each vector and band."""
        chance = np.random.default_rng(self.seed)
        keys = np.empty((len(projected), self.bands), np.uint64)
        for band in range(self.bands):
            of = chance.choice(PROJECTIONS, self.depth, replace=False)
            strip = np.floor((projected[:, of] + chance.uniform(0, STRIP, self.depth)) / STRIP).astype(np.int64)
            key = np.full(len(projected), band + 1, np.uint64)
            for k in range(self.depth):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + strip[:, k].astype(np.uint64))
            keys[:, band] = key
        return keys


def _projected(vectors: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return unit, unit @ plan.directions(vectors.shape[1])


def _by_length(column: pa.Array) -> list[tuple[int, np.ndarray]]:
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return [(int(size), np.flatnonzero(sizes == size)) for size in np.unique(sizes)]


def _cells(classes: DataFrame, plan: Plan) -> DataFrame:
    """(class, dim, band, cell) for every class and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 4096):
                batch = big.slice(at, 4096)
                for size, rows in _by_length(batch.column(1)):
                    part = batch.take(pa.array(rows))
                    keys = plan.cells(_projected(matrix(part.column(1)), plan)[1])
                    names = part.column(0).take(pa.array(np.repeat(np.arange(len(rows)), plan.bands)))
                    bands = np.tile(np.arange(plan.bands, dtype=np.int32), len(rows))
                    dims = np.full(len(bands), size, np.int32)
                    columns = [names, pa.array(dims), pa.array(bands), pa.array(keys.ravel().view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["class", "dim", "band", "cell"])

    return classes.select("class", "vector").mapInArrow(run, "class binary, dim int, band int, cell long")


def _tile_links(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, plan: Plan, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of x and y whose windows collide often enough. px, py: projections in whole bytes."""
    count = np.zeros((len(px), len(py)), np.uint8)
    reach = np.uint8(plan.reach)
    for k in range(PROJECTIONS):
        count += (px[:, k, None] - py[None, :, k] + reach) <= np.uint8(2 * plan.reach)
    a, b = np.nonzero(count >= plan.least)
    if same:
        a, b = a[a < b], b[a < b]
    keep = np.zeros(len(a), bool)
    for at in range(0, len(a), 1 << 16):
        part = slice(at, at + (1 << 16))
        one, other = x[a[part]], y[b[part]]
        dot = np.einsum("ij,ij->i", one, other)
        keep[part] = dot / (np.linalg.norm(one, axis=1) * np.linalg.norm(other, axis=1)) >= plan.cosine
    return a[keep], b[keep]


def _tree(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest one that the links lead to."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = np.minimum(new, new[new])
        if (new == low).all():
            return low
        low = new


def _links(classes: DataFrame, plan: Plan) -> DataFrame:
    """(class, links, head): a tile's number of rows linked to a class, and a class that its links lead to."""
    cells = stored(_cells(classes, plan), "cells")
    sizes = cells.groupBy("dim", "band", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    key = ["dim", "band", "cell"]
    members = cells.join(stored(sizes, "cell-sizes"), key)
    keys = [*key, "low", "high"]
    tiles = (
        members.withColumn("parts", F.ceil(F.col("n") / TILE).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("class", "cell"), "parts").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(*key, F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "class")
        .join(classes.select("class", "vector", "rows"), "class")
    )
    spread = tiles.repartition(shuffle_partitions(classes.sparkSession), *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            bounds = group_starts(table, keys)
            names, weight = table.column("class").combine_chunks(), table.column("rows").to_numpy()
            band, part, low, high = (table.column(c).to_numpy() for c in ("band", "part", "low", "high"))
            vectors = table.column("vector").combine_chunks()
            for start, end in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                x = matrix(vectors.slice(start, end - start))
                _, projected = _projected(x, plan)
                whole = np.clip(np.rint(projected * SCALE), -119, 119).astype(np.int8).view(np.uint8)
                rows = np.arange(end - start)
                left, right = rows[part[start:end] == low[start]], rows[part[start:end] == high[start]]
                a, b = _tile_links(x[left], x[right], whole[left], whole[right], plan, low[start] == high[start])
                if not len(a):
                    continue
                a, b = left[a], right[b]
                linked = np.unique(np.r_[a, b])
                first = plan.cells(projected[linked])
                at_a, at_b = np.searchsorted(linked, a), np.searchsorted(linked, b)
                first_band = np.concatenate([(first[at_a[k : k + 65536]] == first[at_b[k : k + 65536]]).argmax(axis=1) for k in range(0, len(a), 65536)])
                here = first_band == band[start]
                a, b = a[here], b[here]
                links = np.bincount(a, weight[start + b], minlength=len(x)) + np.bincount(b, weight[start + a], minlength=len(x))
                head = _tree(a, b, len(x))
                out = np.flatnonzero(links > 0)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(start + out)), pa.array(links[out].astype(np.int64)), names.take(pa.array(start + head[out]))],
                    names=["class", "links", "head"],
                )

    return spread.mapInArrow(run, "class binary, links long, head binary")


def groups(
    rows: DataFrame,
    cosine: float = 0.9,
    recall: float = 0.999,
    cell_rows: int = 512,
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """A row for each row of ``rows``: id, ``n_links``, ``component_id`` and ``kept``.

    ``recall`` is the chance, for a pair just at ``cosine``, to meet in a cell; closer pairs
    meet more surely. Every link that is counted has been verified.
    """
    all_rows = rows.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    sound = usable(all_rows, "vector").withColumn("class", digest("vector"))
    classes = stored(sound.groupBy("class").agg(F.first("vector").alias("vector"), F.count("*").alias("rows"), F.min("id").alias("id")), "vectors")
    plan = Plan(cosine, classes.count(), recall, cell_rows)
    found = stored(_links(classes, plan), "vector-links")
    counts = stored(found.groupBy("class").agg(F.sum("links").alias("links")), "link-counts")
    edges = found.filter("class <> head").select(F.col("class").alias("a"), F.col("head").alias("b")).distinct()
    labels = components(edges).select(F.col("node").alias("class"), "component")
    named = classes.select("class", "rows", "id").join(labels, "class", "left").join(counts, "class", "left")
    named = stored(named.select("class", "id", F.coalesce("component", "class").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("links")), "named-vectors")
    heads = stored(named.groupBy("component").agg(F.min("id").alias("component_id")), "vector-heads")
    of_class = stored(named.join(heads, "component").select("class", "links", "component_id"), "vector-classes")
    slim = stored(all_rows.select("id", F.when(F.col("vector").isNotNull(), digest("vector")).alias("class")), "vector-rows")
    joined = slim.join(of_class.withColumn("in_class", F.lit(True)), "class", "left")
    component = F.when(F.col("in_class"), F.col("component_id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
