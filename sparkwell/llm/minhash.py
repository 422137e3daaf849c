"""MinHash near-dedup with fast similarity sketching.

A text's set is its distinct word shingles. Its sketch has ``COORDINATES`` coordinates, filled in
rounds: in round i every element is thrown into one bin by that round's hash, and a bin that
is still empty keeps the least value; the last rounds go through the bins one by one with
the whole set, so every bin fills. A set of n elements needs about t ln t / n rounds, not t
passes, and the share of equal coordinates is concentrated around the Jaccard similarity.

Texts with equal sets are one class from the start, so copies are sketched once. The
first ``BANDS * ROWS`` coordinates are banded: a class may link only with classes that
share a band. At similarity 0.8 a pair misses all 32 bands with probability 5e-8. Links are then confirmed on the
full sets, in two steps that never list all pairs of a band's bucket:

1. Every class of a bucket meets the bucket's smallest class.
2. What the confirmed links leave in different components, and only that, is compared by
   sketch, in tiles of bounded size; a pair goes on to the exact test if the sketches agree in
   at least ``least_agree`` of all coordinates (5 standard deviations below 0.8), so only
   pairs that may join two components are written.

A pair is given to the exact test once, in the first band that it shares.

Defined results: a null or empty text, or one of white space alone, has an empty set and links with nothing; a
text with fewer words than a shingle is one shingle; each row gets its own answer, also if rows repeat or
share an id; a row without an id takes part in links but names no component: its group is named by the smallest id
there is, and null if there is none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwell.llm.shared import WORD_BYTES, components, fixed_bytes, group_starts, leaving_nothing, mix, slices, stored, whole_groups
from sparkwell.session import shuffle_partitions
from sparkwell.skew import broadcast_if_small

COORDINATES, BANDS, ROWS = 512, 32, 4
SKETCH_BYTES = 8 * BANDS + COORDINATES - BANDS * ROWS
TILE = 512
#: Members of a bucket from which pairs are confirmed in place.
CROWD = 64

_word = re.compile(WORD_BYTES)
_words: dict[bytes, int] = {}


def _forget() -> None:
    _words.clear()


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct hashed shingles of a text, sorted."""
    found = _word.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not found:
        return np.zeros(0, np.uint64)
    if len(_words) > 100_000:
        _words.clear()
    for w in found:
        if w not in _words:
            _words[w] = xxhash.xxh3_64_intdigest(w)
    each = np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))
    size = min(words, len(each))
    value = np.full(len(each) - size + 1, size, np.uint64)
    for k in range(size):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + each[k : len(each) - size + 1 + k])
    return np.unique(value)


def sketch(elements: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """The filled coordinates of a non-empty set, each as a number that names its round and element."""
    held = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    n, step = len(elements), 0
    empty = np.ones(t, bool)
    while step < t and empty.any():
        rounds = np.arange(step, min(t, step + max(1, int(t * (np.log(t) + 2) / n), 8 if n < 64 else 1)), dtype=np.uint64)
        step += len(rounds)
        value = mix(elements[None, :] ^ mix(rounds + np.uint64(1))[:, None])
        bins = (value & np.uint64(t - 1)).astype(np.int64)
        ranked = (rounds[:, None] << np.uint64(52)) | (value >> np.uint64(12))
        np.minimum.at(held, bins.ravel(), ranked.ravel())
        empty = held == np.iinfo(np.uint64).max
    if empty.any():
        rounds = np.flatnonzero(empty).astype(np.uint64) + np.uint64(t)
        value = mix(elements[None, :] ^ mix(rounds + np.uint64(1))[:, None])
        held[empty] = (rounds << np.uint64(52)) | (value >> np.uint64(12)).min(axis=1)
    return mix(held)


def packed(coordinates: np.ndarray) -> bytes:
    """A sketch in bytes: four 16-bit coordinates a band, then one byte for each of the rest."""
    lead = coordinates[: BANDS * ROWS].astype(np.uint16)
    return lead.tobytes() + coordinates[BANDS * ROWS :].astype(np.uint8).tobytes()


def agreement(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The share of equal coordinates of packed sketches, row by row (broadcast over leading axes)."""
    cut = 8 * BANDS
    a, b = (np.ascontiguousarray(x[..., :cut]).view(np.uint16) for x in (one, other))
    equal = (a == b).sum(axis=-1) + (one[..., cut:] == other[..., cut:]).sum(axis=-1)
    return equal / COORDINATES


def _texts(batch: pa.RecordBatch) -> list[str | None]:
    return batch.column(batch.schema.get_field_index("text")).to_pylist()


def _sketched(docs: DataFrame, words: int) -> DataFrame:
    """(id, text_key, n_shingles, class, sketch) for each row of (id, text); class is the digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            keys, sizes, digests, sketches = [], [], [], []
            for text in _texts(batch):
                found = shingle_set(text, words)
                keys.append(hashlib.md5((text or "").encode("utf-8", "surrogatepass")).digest())
                sizes.append(len(found))
                digests.append(hashlib.md5(found.tobytes()).digest() if len(found) else None)
                sketches.append(packed(sketch(found)) if len(found) else None)
            columns = [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text_key", "n_shingles", "class", "sketch"])

    schema = T.StructType([docs.schema["id"]]).add("text_key", "binary").add("n_shingles", "long").add("class", "binary").add("sketch", "binary")
    return docs.mapInArrow(leaving_nothing(run, _forget), schema)


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(class, shingles) for the classes of ``wanted`` (class, id, n_shingles): their texts are read once more and cut into sets."""
    ids = broadcast_if_small(wanted.select("id").distinct(), max_rows=2_000_000, max_bytes=64 << 20)
    rows = docs.join(ids, docs["id"].eqNullSafe(ids["id"])).select(docs["id"], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            sets = [shingle_set(text, words) for text in _texts(batch)]
            digests = pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary())
            ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([digests, lists], names=["class", "shingles"])

    made = rows.mapInArrow(leaving_nothing(run, _forget), "class binary, shingles array<long>")
    # An id may stand for several texts; one copy of each wanted class is enough.
    return made.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"])


def _agreeing(pairs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sketches (sa, sb) agree well enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 2000):
                batch = big.slice(at, 2000)
                sa, sb = (fixed_bytes(batch.column(k), SKETCH_BYTES) for k in (2, 3))
                yield batch.filter(pa.array(agreement(sa, sb) >= least)).select(["a", "b"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(leaving_nothing(run), "a binary, b binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose full sets are similar enough: den * intersection >= num * union."""
    num, den = similarity
    one = sets.select(F.col("class").alias("a"), F.col("shingles").alias("xa"))
    other = sets.select(F.col("class").alias("b"), F.col("shingles").alias("xb"))
    both = F.size(F.array_intersect("xa", "xb"))
    known = pairs.join(one, "a").join(other, "b")
    return known.filter(both * den >= (F.size("xa") + F.size("xb") - both) * num).select("a", "b")


def _bands(classes: DataFrame) -> DataFrame:
    """(class, band, key): a row for each band of each class."""
    keys = F.transform(F.sequence(F.lit(1), F.lit(8 * BANDS), F.lit(8)), lambda at: F.substring("sketch", at, F.lit(8)))
    return classes.select("class", F.posexplode(keys).alias("band", "bytes")).select(
        "class", "band", F.xxhash64("band", "bytes").alias("key")
    )


def _across(members: DataFrame, least: float, sets: DataFrame | None = None, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """Pairs of a bucket's members in different components, compared by sketch in tiles.

    ``members``: (band, key, n, class, component, sketch) with ``n`` members in the bucket. A
    bucket of many is cut into parts of about ``TILE`` members by hash, and a tile holds two
    parts. Only pairs that agree and share no earlier band are written. With ``sets`` the exact
    test is made inside the tile, and what it links is one component there from then on: a
    tile writes a tree, fewer links than it has members.
    """
    keys = ["band", "key", "low", "high"]
    if sets is not None:
        members = members.join(sets, "class")
    extra = [] if sets is None else ["shingles"]
    tiles = (
        members.withColumn("parts", F.ceil(F.col("n") / TILE).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("class", "key"), "parts").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("band", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "class", "component", "sketch", *extra)
    )
    spread = tiles.repartition(shuffle_partitions(members.sparkSession), *keys).sortWithinPartitions(*keys)
    num, den = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            bounds = group_starts(table, keys)
            sketches = fixed_bytes(table.column("sketch"), SKETCH_BYTES)
            lead = np.ascontiguousarray(sketches[:, : 8 * BANDS]).view(np.uint64)
            band, part, low, high = (table.column(c).to_numpy() for c in ("band", "part", "low", "high"))
            names = table.column("class").to_pylist()
            label = np.unique(np.array(table.column("component").to_pylist()), return_inverse=True)[1]
            if extra:
                lists = table.column("shingles").combine_chunks()
                ends = lists.offsets.to_numpy()
                values = lists.values.to_numpy().view(np.uint64)
            a, b = [], []
            for start, end in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                rows = np.arange(start, end)
                left, right = rows[part[rows] == low[start]], rows[part[rows] == high[start]]
                here = label[start:end].copy()
                for x in left.tolist():
                    y = right[here[right - start] != here[x - start]]
                    y = y[y > x] if low[start] == high[start] else y
                    y = y[(lead[y] == lead[x]).argmax(axis=1) == band[start]] if len(y) else y
                    y = y[agreement(sketches[y], sketches[x]) >= least] if len(y) else y
                    if extra and len(y):
                        mine = values[ends[x] : ends[x + 1]]
                        theirs = [values[ends[i] : ends[i + 1]] for i in y.tolist()]
                        sizes = np.array([len(t) for t in theirs])
                        every = np.concatenate(theirs)
                        at = np.minimum(np.searchsorted(mine, every), len(mine) - 1)
                        both = np.add.reduceat((mine[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
                        y = y[both * den >= (sizes + len(mine) - both) * num]
                        joined, once = np.unique(here[y - start], return_index=True)
                        here[np.isin(here, joined)] = here[x - start]
                        y = y[once]
                    a += [names[x]] * len(y)
                    b += [names[i] for i in y.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return spread.mapInArrow(leaving_nothing(run), "a binary, b binary")


def groups(
    docs: DataFrame,
    words: int = 5,
    similarity: tuple[int, int] = (80, 100),
    least_agree: float = 0.7,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row for each row of ``docs``: id, text_key, ``n_shingles``, ``component_id``, ``kept`` and ``stays``.

    ``component_id`` is the smallest id that links lead to and ``kept`` tells whether it is the
    row's own; ``stays`` is true for just one text of each group (the smallest by id and
    digest). ``similarity`` is (numerator, denominator).
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    rows = stored(_sketched(slim, words), "sketches")
    least_row = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("first_row")
    classes = stored(
        rows.filter("class is not null").groupBy("class").agg(least_row, F.first("sketch").alias("sketch")), "classes"
    )
    bands = _bands(classes)
    buckets = bands.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("class").alias("center")).filter("n > 1")
    members = stored(bands.join(stored(buckets, "buckets"), ["band", "key"]), "members")

    sketch_a = classes.select(F.col("class").alias("a"), F.col("sketch").alias("sa"))
    sketch_b = classes.select(F.col("class").alias("b"), F.col("sketch").alias("sb"))
    star = members.filter("class <> center").select(F.col("center").alias("a"), F.col("class").alias("b")).distinct()
    star = stored(_agreeing(star.join(sketch_a, "a").join(sketch_b, "b"), least_agree), "star-pairs")

    wanted = classes.join(members.select("class").distinct(), "class", "left_semi").select("class", F.col("first_row.id").alias("id"))
    sets = stored(_sets_of(slim, wanted, words), "sets")
    links = stored(_confirmed(star, sets, similarity), "links")
    joined = components(links)

    labels = joined.select(F.col("node").alias("class"), "component")
    labelled = members.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    labelled = stored(labelled.select("band", "key", "n", "class", "component"), "labelled")
    torn = labelled.groupBy("band", "key").agg(F.min("component").alias("lowest"), F.max("component").alias("highest"))
    torn = stored(torn.filter("lowest <> highest").select("band", "key"), "torn-buckets")
    apart = stored(labelled.join(torn, ["band", "key"]), "apart")
    sketches = classes.select("class", "sketch")
    # Where a bucket is crowded, near misses would be many pairs: there the exact test is made in the tile.
    few = _across(apart.filter(F.col("n") <= CROWD).join(sketches, "class"), least_agree)
    many = _across(apart.filter(F.col("n") > CROWD).join(sketches, "class"), least_agree, sets, similarity)
    more = stored(_confirmed(stored(few, "cross-pairs"), sets, similarity).union(many), "cross-links")
    named = classes.select("class", "first_row").join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    if more.take(1):
        # The late links join whole components, so the second search runs on those alone.
        of = named.select("class", "component")
        ends = more.join(of.withColumnRenamed("class", "a"), "a").select(F.col("component").alias("one"), "b")
        ends = ends.join(of.withColumnRenamed("class", "b"), "b").select(F.col("one").alias("a"), F.col("component").alias("b"))
        wider = components(ends).select(F.col("node").alias("component"), F.col("component").alias("wider"))
        named = named.join(wider, "component", "left").select("class", "first_row", F.coalesce("wider", "component").alias("component"))
    named = stored(named, "named-classes")
    heads = stored(named.groupBy("component").agg(F.min("first_row").alias("head")), "heads")
    of_class = stored(named.join(heads, "component").select("class", "head"), "class-heads")
    found = rows.drop("sketch").join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("head.id"))
    return found.select(
        F.col("id").alias(id_col),
        "text_key",
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
        (F.col("class").isNull() | (F.col("id").eqNullSafe(component) & F.col("text_key").eqNullSafe(F.col("head.text_key")))).alias("stays"),
    )


def dedup(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (80, 100), id_col: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """The rows of ``docs`` with all their columns, one of each group of near copies."""
    found = stored(groups(docs, words, similarity, id_col=id_col, text=text, **more), "near-copies")
    stay = found.filter("stays").groupBy(F.col(id_col).alias("_stay_id"), F.col("text_key").alias("_stay_key")).agg(F.min("n_shingles").alias("_stay_n"))
    key = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    joined = docs.withColumn("_row_key", key).join(stay, F.col(id_col).eqNullSafe(F.col("_stay_id")) & (F.col("_row_key") == F.col("_stay_key")))
    repeated = found.filter("stays and n_shingles > 0").groupBy(id_col, "text_key").count().filter("count > 1")
    if repeated.take(1):
        without = joined.filter("_stay_n = 0")
        joined = joined.filter("_stay_n > 0").dropDuplicates(["_stay_id", "_row_key"]).unionByName(without)
    return joined.select(*docs.columns)
