"""Line dedup: exact reference counts per line key, with cuckoo filters by shard in front of them.

A line's key is the line without white space at both ends, A-Z lower-cased. The counts
table holds, for each key, in how many documents it stands. Documents are inserted and
deleted by adding to and taking from the counts, so the work is reversible. Only keys in
at least ``min_docs`` documents are put in the filters; a line that passes its shard's
filter is then looked up in the exact table, so false positives of a filter never drop a line.

Defined results: a null or empty text has one empty line; the empty key never counts; each
row is a document of its own, repeated rows included; without rows the answers are empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.shared import LOWER, SPACES, UPPER, leaving_nothing, mix, slices, stored

KEY_BYTES = 16
ADDED = ("n_lines", "n_dropped", "kept")


class CuckooFilter:
    """Sets of 64-bit hashes as 16-bit fingerprints, four to a bucket, with deletion."""

    SLOTS = 4

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        """Empty, with room for about ``n`` hashes at most 80 % full."""
        buckets = 1 << max(1, int(np.ceil(np.log2(max(n, 1) / (cls.SLOTS * 0.8)))))
        return cls(np.zeros((buckets, cls.SLOTS), np.uint16))

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        room = len(hashes)
        while True:
            made = cls.sized(room)
            if made.insert(hashes):
                return made
            room = 2 * max(room, 1)

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, cls.SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(mark.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = np.maximum(hashes >> np.uint64(48), np.uint64(1)).astype(np.uint16)
        first = (mix(hashes) & np.uint64(len(self.table) - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(hashes)
        return ((self.table[first] == mark[:, None]) | (self.table[second] == mark[:, None])).any(axis=1)

    def _settle(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Put marks in free slots of their buckets; True where there was one."""
        order = np.argsort(bucket, kind="stable")
        rows = bucket[order]
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        turn = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
        free = self.table[rows] == 0
        slot = np.argmax(np.cumsum(free, axis=1) == (turn + 1)[:, None], axis=1)
        fits = turn < free.sum(axis=1)
        self.table[rows[fits], slot[fits]] = mark[order[fits]]
        done = np.zeros(len(bucket), bool)
        done[order[fits]] = True
        return done

    def insert(self, hashes: np.ndarray, rounds: int = 500) -> bool:
        """Add distinct hashes, all at a time; False if the filter is too full."""
        if not len(hashes):
            return True
        mark, first, second = self._places(hashes)
        left = ~self._settle(first, mark)
        bucket, mark = second[left], mark[left]
        chance = np.random.default_rng(7)
        for _ in range(rounds):
            if not len(bucket):
                return True
            left = ~self._settle(bucket, mark)
            bucket, mark = bucket[left], mark[left]
            if not len(bucket):
                return True
            _, lead = np.unique(bucket, return_index=True)
            slot = chance.integers(0, self.SLOTS, len(lead))
            out = self.table[bucket[lead], slot].copy()
            self.table[bucket[lead], slot] = mark[lead]
            mark[lead] = out
            bucket[lead] = self._other(bucket[lead], out)
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Take out hashes that were inserted before."""
        mark, first, second = self._places(hashes)
        for m, a, b in zip(mark.tolist(), first.tolist(), second.tolist(), strict=True):
            for bucket in (a, b):
                at = np.flatnonzero(self.table[bucket] == m)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break


def head_of(keys: list[bytes]) -> np.ndarray:
    """The first eight bytes of each key as a number, which names its shard and its place in a filter."""
    return np.frombuffer(b"".join(k[:8] for k in keys), "<u8")


def line_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, n_docs): in how many rows of ``docs`` each non-empty key stands."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    keys = F.array_distinct(F.transform(lines, lambda x: F.translate(F.trim(x, F.lit(SPACES)), UPPER, LOWER)))
    each = docs.select(F.explode(keys).alias("line")).filter("line <> ''")
    return each.groupBy(F.unhex(F.md5("line")).alias("key")).agg(F.count("*").alias("n_docs"))


def inserted(counts: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The counts after the documents have come in."""
    return _added(counts, line_counts(docs, text))


def deleted(counts: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The counts after the documents, inserted before, have gone."""
    return _added(counts, line_counts(docs, text).withColumn("n_docs", -F.col("n_docs")))


def _added(counts: DataFrame, change: DataFrame) -> DataFrame:
    summed = counts.select("key", "n_docs").union(change).groupBy("key").agg(F.sum("n_docs").alias("n_docs"))
    return summed.filter("n_docs > 0")


def shards_for(n: int, per_shard: int = 1_000_000) -> int:
    return max(1, -(-n // per_shard))


def _shard(key: str, shards: int) -> Column:
    tail = F.conv(F.hex(F.substring(key, KEY_BYTES - 3, 4)), 16, 10).cast("long")
    return F.pmod(tail, F.lit(shards)).cast("int")


def _shard_of(key: bytes, shards: int) -> int:
    return int.from_bytes(key[-4:], "big") % shards


def filters_of(counts: DataFrame, min_docs: int, shards: int) -> DataFrame:
    """(shard, n_keys, filter): a cuckoo filter of each shard's keys in at least ``min_docs`` documents."""
    frequent = counts.filter(F.col("n_docs") >= min_docs).select("key", _shard("key", shards).alias("shard"))

    def build(key, rows):
        hashes = head_of(rows["key"].tolist())
        return _filter_row(key[0], len(hashes), CuckooFilter.of(np.unique(hashes)))

    return frequent.groupBy("shard").applyInPandas(build, "shard int, n_keys long, filter binary")


def updated_filters(filters: DataFrame, before: DataFrame, after: DataFrame, min_docs: int, shards: int) -> DataFrame:
    """``filters`` after the counts went from ``before`` to ``after``: keys that crossed the bound are inserted or deleted.

    A filter that gets too full is built again from the exact counts of its shard.
    """
    old = before.select("key", (F.col("n_docs") >= min_docs).alias("was"))
    new = after.select("key", (F.col("n_docs") >= min_docs).alias("is"))
    state = old.join(new, "key", "full").select(
        "key", F.coalesce("was", F.lit(False)).alias("was"), F.coalesce("is", F.lit(False)).alias("is")
    )
    keys = state.filter("was or is").withColumn("shard", _shard("key", shards))

    def change(shard, kept, rows):
        hashes = head_of(rows["key"].tolist())
        was, now = rows["was"].to_numpy(bool), rows["is"].to_numpy(bool)
        current = np.unique(hashes[now])
        if len(kept):
            held = CuckooFilter.from_bytes(kept["filter"].iloc[0])
            held.delete(np.setdiff1d(hashes[was], current))
            if held.insert(np.setdiff1d(current, hashes[was])):
                return _filter_row(shard[0], int(now.sum()), held)
        return _filter_row(shard[0], int(now.sum()), CuckooFilter.of(current))

    pairs = filters.groupBy("shard").cogroup(keys.groupBy("shard"))
    return pairs.applyInPandas(change, "shard int, n_keys long, filter binary")


def _filter_row(shard: int, n: int, made: CuckooFilter):
    import pandas as pd

    return pd.DataFrame({"shard": [shard], "n_keys": [n], "filter": [made.to_bytes()]})


def drop_lines(
    docs: DataFrame,
    counts: DataFrame,
    min_docs: int,
    id_col: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = 64 << 20,
    keys_per_shard: int = 1_000_000,
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept`` (the other lines, joined by a line break) for each row.

    ``counts`` must be a stored table. Every key in at least ``min_docs`` documents loses all
    its lines. While the frequent keys and their filters stay below ``broadcast_bytes``, they
    are sent to the tasks and no text is shuffled. Beyond that bound, keys of lines meet the filter of
    their shard in a shuffle, and those that pass the exact table in another. Both ways give the same rows.
    """
    frequent = stored(counts.filter(F.col("n_docs") >= min_docs).select("key"), "frequent-lines")
    n = frequent.count()
    shards = shards_for(n, keys_per_shard)
    if n * (KEY_BYTES + 8) <= broadcast_bytes:
        return _dropped_in_place(docs, frequent, n, shards, min_docs, text)
    return _dropped_by_join(docs, frequent, shards, min_docs, text)


def _line_keys(text: bytes) -> tuple[list[bytes], list[bytes]]:
    lines = text.split(b"\n")
    return lines, [hashlib.md5(x).digest() if (x := line.strip(SPACES.encode()).lower()) else b"" for line in lines]


def _dropped_in_place(docs: DataFrame, frequent: DataFrame, n: int, shards: int, min_docs: int, text: str) -> DataFrame:
    spark = docs.sparkSession
    counted = frequent.withColumn("n_docs", F.lit(min_docs))
    filters = {r["shard"]: bytes(r["filter"]) for r in filters_of(counted, min_docs, shards).collect()}
    exact = frozenset(bytes(r["key"]) for r in frequent.toLocalIterator())
    shared = spark.sparkContext.broadcast((filters, exact))
    names = [c for c in docs.columns if c not in ADDED]
    zero = F.lit(0).cast("long")
    out_schema = docs.select(*names, zero.alias("n_lines"), zero.alias("n_dropped"), F.lit("").alias("kept")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, exact = shared.value
        tables = {shard: CuckooFilter.from_bytes(x) for shard, x in raw.items()}
        for batch in slices(batches, text):
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            split = [_line_keys(x or b"") for x in texts]
            keys = [k for _, ks in split for k in ks]
            places: dict[int, list[int]] = {}
            for i, k in enumerate(keys):
                if k:
                    places.setdefault(_shard_of(k, shards) if shards > 1 else 0, []).append(i)
            drop = np.zeros(len(keys), bool)
            for shard, at in places.items():
                if shard in tables:
                    maybe = tables[shard].contains(head_of([keys[i] for i in at]))
                    for i in np.asarray(at)[maybe].tolist():
                        drop[i] = keys[i] in exact
            n_lines, n_dropped, kept, at = [], [], [], 0
            for lines, ks in split:
                gone = drop[at : at + len(ks)]
                at += len(ks)
                n_lines.append(len(lines))
                n_dropped.append(int(gone.sum()))
                kept.append(b"\n".join([x for x, g in zip(lines, gone.tolist(), strict=True) if not g]))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *ADDED])

    return docs.select(*names).mapInArrow(leaving_nothing(run), out_schema)


def through_filters(lines: DataFrame, filters: DataFrame, shards: int, rows_per_task: int = 500_000) -> DataFrame:
    """The rows of ``lines`` (with a ``key``) that pass the filter of their key's shard.

    A shard with many lines, as that of a very frequent line, goes to several tasks, each with a copy of its one filter.
    """
    placed = lines.withColumn("shard", _shard("key", shards))
    turns = placed.groupBy("shard").agg(F.ceil(F.count("*") / rows_per_task).cast("int").alias("turns"))
    turns = stored(turns, "filter-turns")  # a row for each shard of a million frequent keys
    spread = F.pmod(F.xxhash64("_text_key", "at"), F.col("turns")).cast("int").alias("turn")
    many = placed.join(F.broadcast(turns), "shard").select(*lines.columns, "shard", spread)
    held = filters.join(F.broadcast(turns), "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "filter")
    names = lines.columns

    def passed(rows: pa.Table, own: pa.Table) -> pa.Table:
        rows = rows.select(names)
        if not own.num_rows or not rows.num_rows:
            return rows.slice(0, 0)
        maybe = CuckooFilter.from_bytes(own.column("filter")[0].as_py()).contains(head_of(rows.column("key").to_pylist()))
        return rows.filter(pa.array(maybe))

    return many.groupBy("shard", "turn").cogroup(held.groupBy("shard", "turn")).applyInArrow(passed, lines.schema)


def _dropped_by_join(docs: DataFrame, frequent: DataFrame, shards: int, min_docs: int, text: str) -> DataFrame:
    """Decisions depend on the text alone, so they are joined back by its digest; repeated texts share them."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    rows = docs.drop(*ADDED).withColumn("_text_key", F.unhex(F.md5(F.coalesce(text, F.lit("")))))
    line = F.translate(F.trim(F.col("line"), F.lit(SPACES)), UPPER, LOWER)
    each = rows.dropDuplicates(["_text_key"]).select("_text_key", F.posexplode(lines).alias("at", "line")).select("_text_key", "at", line.alias("line"))
    filters = stored(filters_of(frequent.withColumn("n_docs", F.lit(min_docs)), min_docs, shards), "line-filters")
    keyed = each.filter("line <> ''").select("_text_key", "at", F.unhex(F.md5("line")).alias("key"))
    hits = through_filters(keyed, filters, shards).join(frequent, "key").select("_text_key", "at")
    drops = stored(hits.groupBy("_text_key").agg(F.collect_list("at").alias("_gone")), "dropped-lines")
    joined = rows.join(drops, "_text_key", "left").withColumn("_lines", lines)
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), gone)
    kept = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    return joined.select(
        *[c for c in rows.columns if c != "_text_key"],
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )


def dedup(docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """Count the lines of ``docs`` and drop those found in at least ``min_docs`` of them."""
    return drop_lines(docs, stored(line_counts(docs, text), "line-counts"), min_docs, id_col, text, **more)
