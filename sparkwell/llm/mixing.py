"""Mixing sources to target weights by fitting each source's word budget as a subset sum over exact lengths.

Every source has a target in words. Whole copies of a source are taken while they fit; what is
left is fitted with single documents. Documents are counted by (source, length). Each
length first gives its proportional share, rounded down; long documents then close most
of the gap, and a bounded-knapsack dynamic programme over the lengths still to be had finds
the sum nearest to the rest from below. Where that misses the target, documents taken are
exchanged for others by the same kind of programme, long ones included. Which documents
of a length are taken is drawn by a seeded hash, so reruns agree.

Defined results: a null text has length 0; a null source is a source of its own and comes
last; documents of length 0 are never taken; repeated rows are documents of their own;
a source whose words are all 0 has target 0; without rows the answer is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwell.llm.shared import WORD, stored

#: Documents of one length that are put in order together.
BUCKET_ROWS = 512


def cyclic_weights(sources: Sequence[str | None], cycle: Sequence[float]) -> dict[str | None, float]:
    """Sources by code point, null last, weigh the values of ``cycle``, which repeats."""
    named = sorted(s for s in sources if s is not None) + [s for s in sources if s is None][:1]
    return {s: cycle[i % len(cycle)] for i, s in enumerate(named)}


def targets(sizes: Mapping[str | None, int], weights: Mapping[str | None, float], share: float, most: float) -> dict:
    """Words for each source: ``share`` of all words by weight; none above ``most`` times its size, the excess shared again."""
    left, open_, found = share * sum(sizes.values()), set(sizes), {}
    while open_:
        unit = left / (sum(weights[s] for s in open_) or 1)
        above = {s for s in open_ if unit * weights[s] > most * sizes[s]}
        if not above:
            return found | {s: unit * weights[s] for s in open_}
        for s in above:
            found[s] = float(most * sizes[s])
            left -= found[s]
        open_ -= above
    return found


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, capacity: int = 1 << 16, exchange: int = 1 << 23) -> np.ndarray:
    """How many documents of each length to take, so that their words come as near to ``budget`` from below as possible.

    Shares and a dynamic programme over at most ``capacity`` words come first. If they miss the
    budget, documents taken are exchanged for others, up to ``exchange`` words each way: the
    nearest sum of all for budgets up to ``exchange`` words, the nearest that such an
    exchange gives for any. Lengths count in steps of their common divisor.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    step = int(np.gcd.reduce(lengths[counts > 0])) if (counts > 0).any() else 0
    if step > 1:
        lengths, budget = lengths // step, budget // step
    total = int((lengths * counts).sum())
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    if budget <= 0:
        return np.zeros_like(counts)
    taken = np.array([int(c) * budget // total if n else 0 for n, c in zip(lengths, counts, strict=True)], np.int64)
    left = budget - int((lengths * taken).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= capacity:
            break
        n = int(lengths[i])
        if n:
            more = min(int(counts[i] - taken[i]), left // n)
            taken[i] += more
            left -= more * n
    if left <= capacity:
        taken = taken + _knapsack(lengths, counts - taken, left)
    left = budget - int((lengths * taken).sum())
    return taken + _exchanged(lengths, taken, counts - taken, left, exchange) if left else taken


def _knapsack(lengths: np.ndarray, spare: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum: as many of each length as make the largest sum up to ``budget``."""
    parcels = list(_parcels(lengths, spare, budget))
    reach, made = 1, 0
    while made < len(parcels) and not reach >> budget & 1:
        reach = _widened(reach, parcels[made], budget)
        made += 1
    return _traced(len(lengths), parcels[:made], reach.bit_length() - 1, budget)


def _exchanged(lengths: np.ndarray, taken: np.ndarray, spare: np.ndarray, left: int, most: int) -> np.ndarray:
    """Documents to give back (negative) and to take instead, so that the words grow by ``left`` or as near below as can be.

    Sums that can be given back and sums that can be taken grow by a parcel in turn, the longest
    documents first, until two of them differ by ``left``; else the best two of all are used.
    """
    back, more = list(_parcels(lengths, taken, most)), list(_parcels(lengths, spare, most))
    gone, got = 1, 1
    for k in range(max(len(back), len(more))):
        gone = _widened(gone, back[k], most) if k < len(back) else gone
        got = _widened(got, more[k], most) if k < len(more) else got
        if gone & got >> left:
            break
    returned, added = _set_bits(gone), _set_bits(got)
    partner = added[np.searchsorted(added, returned + left, side="right") - 1]
    best = int(np.argmax(partner - returned))
    if partner[best] <= returned[best]:
        return np.zeros_like(taken)
    into = _traced(len(lengths), more[: k + 1], int(partner[best]), most)
    return into - _traced(len(lengths), back[: k + 1], int(returned[best]), most)


def _parcels(lengths: np.ndarray, counts: np.ndarray, most: int) -> Iterator[tuple[int, int, int]]:
    """(index, copies, words): each length in parcels of 1, 2, 4, ... copies, the longest first, none beyond ``most`` words."""
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        left, k = min(int(counts[i]), most // n) if n else 0, 1
        while left:
            k = min(k, left)
            yield i, k, n * k
            left -= k
            k *= 2


def _widened(reach: int, parcel: tuple[int, int, int], most: int) -> int:
    """The sums of ``reach``, a bit each, with and without a parcel; none above ``most``."""
    return reach | reach << parcel[2] & (1 << most + 1) - 1


def _traced(n: int, parcels: list[tuple[int, int, int]], at: int, most: int) -> np.ndarray:
    """Copies of each of ``n`` lengths whose words come to ``at``. Sums are kept at the beginnings of blocks and made again inside one."""
    copies, block = np.zeros(n, np.int64), math.isqrt(len(parcels)) + 1
    starts, reach = [], 1
    for k, parcel in enumerate(parcels):
        if k % block == 0:
            starts.append(reach)
        reach = _widened(reach, parcel, most)
    for b in reversed(range(len(starts))):
        inside, before = parcels[b * block : (b + 1) * block], [starts[b]]
        for parcel in inside[:-1]:
            before.append(_widened(before[-1], parcel, most))
        for (i, k, words), sums in zip(reversed(inside), reversed(before), strict=True):
            if not sums >> at & 1:
                copies[i] += k
                at -= words
    return copies


def _set_bits(sums: int) -> np.ndarray:
    raw = np.frombuffer(sums.to_bytes(sums.bit_length() // 8 + 1, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


def _dealt(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """``quota``: how much of its key's ``pick`` each row takes, in order, up to what it ``held``; rows that take something."""
    before = F.sum("held").over(Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    quota = F.least("held", F.greatest(F.lit(0), F.col("pick") - F.coalesce(before, F.lit(0))))
    return rows.withColumn("quota", quota).filter("quota > 0")


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _draws(seed: int, id_col: str, text: str, source: str) -> list[Column]:
    """``draw`` and ``again``: two seeded hashes of a row's id, text and source, 128 bits that tell rows apart."""
    row = [F.col(id_col), F.col(text), F.col(source)]
    return [F.xxhash64(F.lit(seed), *row).alias("draw"), F.xxhash64(F.lit(seed), F.lit("again"), *row).alias("again")]


def decide(
    docs: DataFrame,
    weights: Mapping[str | None, float] | Sequence[float],
    share: float = 1.5,
    most: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """A row for each document: id, row key, source, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` words.

    ``weights`` names a weight for each source, or is a cycle of weights for the sources in
    order. The driver holds a row for each source. Texts are read once and never shuffled.
    """
    spark = docs.sparkSession
    slim = stored(
        docs.select(
            F.col(id_col).alias("id"),
            *_draws(seed, id_col, text, source),
            F.col(source).alias("source"),
            words_in(text).alias("size"),
        ).withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))),
        "sizes",
    )
    sums = {r["source"]: int(r["size"]) for r in slim.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    if not isinstance(weights, Mapping):
        weights = cyclic_weights(list(sums), weights)
    aim = targets(sums, weights, share, most)
    goals = []
    for s, words in sums.items():
        full = min(int(aim[s] // words), most) if words else 0
        rest = math.floor(aim[s] - full * words + 0.5) if full < most else 0
        goals.append(("" if s is None else "=" + s, words, float(aim[s]), full, rest))
    goal = spark.createDataFrame(goals, "source_key string, source_size long, target double, full int, rest long")

    by_length = slim.groupBy("source_key", "size").agg(F.count("*").alias("n"))

    def choose(rows):
        rows = rows.sort_values("size")
        rows["pick"] = fit(rows["size"].to_numpy(), rows["n"].to_numpy(), int(rows["rest"].iloc[0]))
        return rows

    plan = by_length.join(F.broadcast(goal), "source_key").select(
        "source_key", "size", "n", "source_size", "target", "full", "rest", F.lit(0).cast("long").alias("pick")
    )
    plan = stored(plan.groupBy("source_key").applyInPandas(choose, plan.schema), "mixing-plan")

    # A length's documents are put in hashed buckets of bounded size; only the bucket that the
    # quota ends in is taken in part, by order of the draw.
    key = ["source_key", "size"]
    buckets = F.ceil(F.col("n") / BUCKET_ROWS).cast("long")
    rows = stored(slim.join(plan, key).withColumn("bucket", F.pmod("draw", buckets)), "mixing-rows")
    held = rows.filter("pick > 0 and pick < n").groupBy(*key, "bucket").agg(F.count("*").alias("held"), F.max("pick").alias("pick"))
    held = stored(held.withColumn("shelf", F.floor(F.col("bucket") / BUCKET_ROWS)), "mixing-held")
    # The quota goes to shelves of buckets first, so that no window holds all buckets of a very frequent length.
    shelves = held.groupBy(*key, "shelf").agg(F.sum("held").alias("held"), F.max("pick").alias("pick"))
    shelves = _dealt(shelves, key, "shelf").select(*key, "shelf", F.col("quota").alias("pick"))
    buckets_on = held.drop("pick").join(shelves, [*key, "shelf"])
    quota = stored(_dealt(buckets_on, [*key, "shelf"], "bucket").select(*key, "bucket", "quota", "held"), "mixing-quota")
    place = F.row_number().over(Window.partitionBy(*key, "bucket").orderBy("draw", "again"))
    part = rows.filter("pick > 0 and pick < n").join(quota, [*key, "bucket"], "left")
    part = part.withColumn("extra", (place <= F.coalesce("quota", F.lit(0))).cast("int")).drop("quota", "held")
    whole = rows.filter("pick = 0 or pick = n").withColumn("extra", (F.col("pick") > 0).cast("int"))
    copies = (F.col("full") + F.col("extra")).cast("long")
    return whole.unionByName(part).select(
        F.col("id").alias(id_col),
        "draw",
        "again",
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, copies).otherwise(0).alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame, weights, share: float = 1.5, most: int = 2, seed: int = 17, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken."""
    made = decide(docs, weights, share, most, seed, id_col, text, source)
    copies = stored(made.groupBy(F.col("draw").alias("_draw"), F.col("again").alias("_again")).agg(F.count("*").alias("_mix_rows"), F.sum("copies").alias("_mix_copies")).filter("_mix_copies > 0"), "mixing-copies")
    names = docs.columns
    draw, again = _draws(seed, id_col, text, source)
    keyed = docs.withColumn("_mix_draw", draw).withColumn("_mix_again", again)
    joined = keyed.join(copies, (keyed["_mix_draw"] == copies["_draw"]) & (keyed["_mix_again"] == copies["_again"]))
    # Rows that are alike in id, text and source share their copies evenly, the first ones getting what is left over.
    turn = F.row_number().over(Window.partitionBy("_mix_draw", "_mix_again").orderBy("_mix_draw"))
    one = joined.filter("_mix_rows = 1").withColumn("_mix_n", F.col("_mix_copies"))
    many = joined.filter("_mix_rows > 1").withColumn(
        "_mix_n", F.floor(F.col("_mix_copies") / F.col("_mix_rows")) + (turn <= F.col("_mix_copies") % F.col("_mix_rows")).cast("int")
    )
    turns = F.explode(F.sequence(F.lit(1), F.col("_mix_n").cast("int")))
    return one.unionByName(many).filter("_mix_n > 0").withColumn("_mix_turn", turns).select(*names)
