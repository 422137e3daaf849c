"""Substring dedup by sliding runs of sentences.

A text is cut into sentences: everything up to and with a row of full stops, question or
exclamation marks or line breaks. Every run of ``span`` consecutive sentences is hashed, runs
are joined over the whole corpus, and every sentence under a run that is not the first of its kind is
removed. Sentences are compared without white space at both ends, A-Z lower-cased. A run of fewer
than ``least_words`` words would repeat by chance, so a run takes as many sentences, ``span`` at least,
as it needs for ``least_words`` words. Where the text ends before that, the shortest run at its end that
has them covers the last sentences, so every sentence of a text with enough words lies under a run.

The first pass only counts hashes; the second gathers places of repeated runs alone. Repeated
hashes go to the tasks below a checked size, else both meet in a shuffle, with the same answer.

Defined results: null counts as empty, which has no sentence; a text with fewer sentences than a run loses
nothing; the first run is that of the smallest id (null ids last), then text digest, then place; rows with equal id and text are one document
and share their answer.
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

from sparkwell.llm.shared import packed_longs, slices, stored

SENTENCE = r"[^.!?\n]+[.!?\n]*|[.!?\n]+"

#: Runs of more sentences get their digest from a polynomial over the sentences' digests, modulo a prime.
LONG = 64
PRIME = (1 << 127) - 1
BASE = xxhash.xxh3_128_intdigest(b"sentences") % PRIME

_sentence = re.compile(SENTENCE.encode())


def sentences(raw: bytes) -> list[bytes]:
    """The sentences, which add up to the text."""
    return _sentence.findall(raw)


def _bounds(words: np.ndarray, span: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs; ``words``: how many there are before each sentence, and in all."""
    n = len(words) - 1
    starts = np.arange(max(0, n - span + 1))
    ends = np.maximum(starts + span, np.searchsorted(words, words[starts] + least_words))
    last = starts[words[n] - words[starts] >= least_words][-1:]
    starts, ends = starts[ends <= n], ends[ends <= n]
    if len(last) and ends[-1] < n:
        starts, ends = np.append(starts, last), np.append(ends, n)
    return starts, ends


def runs(raw: bytes, span: int, least_words: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Places of a text's runs, their numbers of sentences and their digests."""
    keys = [s.strip(b" \t\n\x0b\f\r").lower() for s in sentences(raw)]
    words = np.fromiter((len(k.split()) for k in keys), np.int64, len(keys))
    starts, ends = _bounds(np.r_[0, np.cumsum(words)], span, least_words)
    digests, folded, powers = [], [], []
    for at, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if end - at <= LONG:
            # Inside a sentence no line break is followed by another character than an end mark.
            digests.append(xxhash.xxh3_128_digest(b"\n\0".join(keys[at:end])))
            continue
        # Runs over many sentences without words would hash them again and again, so they are cut from one sum.
        if not folded:
            folded, powers = [0], [1]
            for k in keys:
                folded.append((folded[-1] * BASE + xxhash.xxh3_128_intdigest(k)) % PRIME)
                powers.append(powers[-1] * BASE % PRIME)
        value = (folded[end] - folded[at] * powers[end - at]) % PRIME
        digests.append(xxhash.xxh3_128_digest(b"%d %d" % (end - at, value)))
    return starts, ends - starts, digests


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()]


def _heads_of(digests: list[bytes]) -> np.ndarray:
    """The first eight bytes of each digest, as a number."""
    return np.frombuffer(b"".join(digests), ">i8")[::2].astype(np.int64)


def _places(docs: DataFrame, span: int, least_words: int, only: np.ndarray | None) -> DataFrame:
    """(id, text_key, at, size, run) of the runs of (id, text); with ``only``, of those whose head is in it."""
    known = None if only is None else docs.sparkSession.sparkContext.broadcast(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            texts = _texts(batch)
            found = [runs(raw, span, least_words) for raw in texts]
            rows = np.repeat(np.arange(len(found)), [len(f[2]) for f in found])
            ats, sizes = (np.concatenate([f[i] for f in found]).astype(np.int32) for i in (0, 1))
            digests = [d for f in found for d in f[2]]
            keep = np.arange(len(rows))
            if known is not None and len(rows):
                heads = _heads_of(digests)
                spot = np.searchsorted(known.value, heads)
                keep = np.flatnonzero(known.value.take(spot, mode="clip") == heads) if len(known.value) else keep[:0]
            rows = rows[keep]
            keys = {row: hashlib.md5(texts[row]).digest() for row in np.unique(rows).tolist()}
            columns = [batch.column(0).take(pa.array(rows)), pa.array([keys[r] for r in rows.tolist()], pa.binary())]
            columns += [pa.array(ats[keep]), pa.array(sizes[keep]), pa.array([digests[i] for i in keep.tolist()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text_key", "at", "size", "run"])

    schema = docs.select("id", F.lit(b"").alias("text_key"), F.lit(0).alias("at"), F.lit(0).alias("size"), F.lit(b"").alias("run")).schema
    return docs.mapInArrow(run, schema)


def _heads(docs: DataFrame, span: int, least_words: int) -> DataFrame:
    """(head): the first eight bytes of each run's digest, as a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            digests = [d for raw in _texts(batch) for d in runs(raw, span, least_words)[2]]
            yield pa.RecordBatch.from_arrays([pa.array(_heads_of(digests))], names=["head"])

    return docs.select("text").mapInArrow(run, "head long")


def covered(
    docs: DataFrame,
    span: int = 2,
    least_words: int = 10,
    id_col: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """(id, text_key, gone): the first sentence and the end of each row of sentences to be removed, for each document that loses any."""
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = _heads(slim, span, least_words).groupBy("head").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = stored(counts.select("head"), "repeated-runs")
    if repeated.count() * 8 <= broadcast_bytes:
        places = _places(slim, span, least_words, packed_longs(repeated, "head"))
    else:
        head = F.conv(F.hex(F.substring("run", 1, 8)), 16, -10).cast("long")
        places = _places(slim, span, least_words, None).withColumn("head", head).join(repeated, "head").drop("head")
    places = stored(places, "run-places")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key", "at")
    firsts = places.groupBy("run").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    firsts = stored(firsts.filter(~F.col("first").eqNullSafe(F.col("last"))).select("run", "first"), "first-runs")
    later = places.join(firsts, "run").filter(~order.eqNullSafe(F.col("first")))
    # A document has at most one run more than sentences, so a list is bounded by its length.
    lists = later.groupBy("id", "text_key").agg(F.collect_set(F.struct("at", "size")).alias("gone"))
    schema = lists.select("id", "text_key", F.array(F.lit(0)).alias("gone")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for found in batch.column(2):
                at, size = (found.values.field(c).to_numpy(zero_copy_only=False) for c in ("at", "size"))
                n = int((at + size).max()) + 1
                under = np.cumsum(np.bincount(at, minlength=n) - np.bincount(at + size, minlength=n)) > 0
                rows.append(np.flatnonzero(np.diff(under, prepend=False)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], names=schema.names)

    return stored(lists.mapInArrow(run, schema), "later-runs")


def dedup(
    docs: DataFrame,
    span: int = 2,
    least_words: int = 10,
    id_col: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """``docs`` with ``n_sentences``, ``n_removed`` and ``kept``; columns of these names are replaced, all others stay."""
    gone = covered(docs, span, least_words, id_col, text, broadcast_bytes)
    size = gone.agg(F.coalesce(F.sum(F.size("gone") * 8 + 160), F.lit(0))).first()[0]
    names = [c for c in docs.columns if c not in ("n_sentences", "n_removed", "kept")]
    side = gone.select(F.col("id").alias("_gone_id"), F.col("text_key").alias("_gone_key"), F.col("gone").alias("_gone_at"))
    side = F.broadcast(side) if size <= broadcast_bytes else side
    key = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    joined = docs.select(*names).join(side, F.col(id_col).eqNullSafe(F.col("_gone_id")) & (key == F.col("_gone_key")), "left").select(*names, "_gone_at")
    zero = F.lit(0).cast("long")
    schema = docs.select(*names, zero.alias("n_sentences"), zero.alias("n_removed"), F.lit("").alias("kept")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 4 << 20):
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            lists = batch.column(batch.schema.get_field_index("_gone_at")).to_pylist()
            total, removed, kept = [], [], []
            for raw, bounds in zip(texts, lists, strict=True):
                parts = sentences(raw or b"")
                drop = {i for a, b in zip((bounds or [])[::2], (bounds or [])[1::2], strict=True) for i in range(a, b)}
                total.append(len(parts))
                removed.append(len(drop))
                kept.append(b"".join([p for i, p in enumerate(parts) if i not in drop]))
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns += [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(run, schema)
