"""Exact substring dedup by prefix-free parsing.

A rolling hash over 16 bytes triggers phrase ends. A window of ``length`` bytes belongs to the
first trigger behind its start, which depends on the window's own bytes alone: a rare
trigger if there is one within ``REACH`` bytes, else a frequent one, else the place of the
least hash. So equal windows cut at the same place into the end of a phrase (the
dictionary's side) and a stretch of the parse that follows it, and every window is looked
after by one cut. All windows of one cut share the bytes behind it, its *core*.

1. Cores are counted in the whole corpus. A core found once holds no repeated window. If a
   core is found again and its cuts have equal surroundings, all their windows repeat.
2. Only cores with different surroundings are left, mostly at the edges of repeated passages.
   For these the suffixes of the phrases in front are sorted (the suffix array of the
   dictionary, with the lengths that neighbours have in common), and so are the stretches
   behind (the suffix array of the parse, likewise). Both orders together put the windows in
   corpus order: windows with equal rank in both are equal.

Equal surroundings are one entry with a count, so copies add no work. A core with very many
different surroundings is split by more of the text around it until each part holds few.
The fingerprints of repeated cores go to the tasks while they stay below a checked size;
beyond it, cuts meet them in a shuffle. Both ways give the same answer.

Defined results: null counts as empty; a text shorter than ``length`` loses nothing; every row is a
document, repeated rows included, so two rows with one long text lose it both; matches never cross rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.shared import group_starts, mix, packed_longs, slices, stored, whole_groups
from sparkwell.session import shuffle_partitions

WINDOW = 16
RARE, FREQUENT = 64, 16
REACH = 192
#: Different surroundings of a core that one group may hold, and the width of the parts that larger ones are split into.
GROUP, PART = 1024, 4

_digest = xxhash.xxh3_128_digest


def rolling(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``WINDOW`` bytes from each place on, as many as there are whole windows."""
    if len(raw) < WINDOW:
        return np.zeros(0, np.uint64)
    value, factor, width = mix(raw.astype(np.uint64) + np.uint64(1)), np.uint64(0x9E3779B97F4A7C15), 1
    while width < WINDOW:
        value = value[:-width] * factor + value[width:]
        with np.errstate(over="ignore"):
            factor = factor * factor
        width *= 2
    return mix(value)


def _between(marks: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cuts for the window starts of the ranges first..last: each start belongs to the first mark at most REACH - 1 behind it.

    Returns (cut, from, to) for the starts that have a mark, and the ranges (from, to) of those that have none.
    ``first`` and ``last`` are sorted and the ranges are further apart than they are from their marks.
    """
    # The edges in order: the place before each range, and the marks.
    edges = np.unique(np.concatenate([marks, first - 1]))
    begin = edges + 1
    ahead = np.append(edges[1:], np.iinfo(np.int64).max // 2)
    at = np.searchsorted(first, begin, side="right") - 1
    inside = (at >= 0) & (begin <= last[np.maximum(at, 0)])
    begin, ahead, at = begin[inside], ahead[inside], at[inside]
    # Behind the last mark of a range the next edge may be the next range's front.
    is_mark = np.isin(ahead, marks, assume_unique=False)
    ahead = np.where(is_mark, ahead, np.iinfo(np.int64).max // 2)
    end = last[at]
    low = np.maximum(begin, ahead - REACH + 1)
    high = np.minimum(ahead, end)
    own = low <= high
    bare_to = np.minimum(end, ahead - REACH)
    bare = begin <= bare_to
    return ahead[own], low[own], high[own], begin[bare], bare_to[bare]


def _least_places(hashes: np.ndarray, first: int, last: int) -> np.ndarray:
    """For each start in first..last the place of the least hash among the REACH from there on; the first of equals."""
    part = hashes[first : last + REACH]
    value = (part >> np.uint64(32) << np.uint64(32)) | np.arange(len(part), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH:
        value = np.minimum(value[:-width], value[width:])
        width *= 2
    rest = REACH - width
    value = np.minimum(value[: len(value) - rest], value[rest:]) if rest else value
    return first + (value[: last - first + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def cuts(raw: bytes, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cut, from, to): each cut with the window starts that it looks after, for documents starts..ends in one buffer.

    Every start of a whole window, start <= i <= end - length, belongs to just one cut.
    """
    long = ends - starts >= length
    first, last = starts[long], ends[long] - length
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = rolling(np.frombuffer(raw, np.uint8))
    rare = np.flatnonzero((hashes & np.uint64(RARE - 1)) == 0)
    found = [_within(rare, first, last, ends[long])]
    bare_first, bare_last = found[0][3:]
    if len(bare_first):
        frequent = np.flatnonzero((hashes & np.uint64(FREQUENT - 1)) == 0)
        # A bare range has no rare trigger in reach, so its frequent triggers are those of its own windows.
        more = _within(frequent, bare_first, bare_last, bare_last + REACH + WINDOW)
        found.append(more)
        for a, b in zip(more[3].tolist(), more[4].tolist(), strict=True):
            place = _least_places(hashes, a, b)
            new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            found.append((place[new], a + new, a + np.r_[new[1:], len(place)] - 1))
    cut, low, high = (np.concatenate([f[k] for f in found]) for k in range(3))
    return cut, low, high


def _within(marks: np.ndarray, first: np.ndarray, last: np.ndarray, ends: np.ndarray):
    """:func:`_between` with only the marks whose windows lie in a range's text."""
    at = np.searchsorted(first, marks, side="right") - 1
    inside = (at >= 0) & (marks + WINDOW <= ends[np.maximum(at, 0)])
    return _between(marks[inside], first, last)


def _joined(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    bounds = np.cumsum([0, *map(len, texts)])
    return b"".join(texts), bounds[:-1], bounds[1:]


def _core(length: int) -> int:
    return length - REACH + 1


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()]


def _parsed(docs: DataFrame, length: int) -> DataFrame:
    """(core, around) of every cut: 64-bit fingerprints of its core and of its whole surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            raw, starts, ends = _joined(_bytes(batch))
            core, around = _prints(raw, *cuts(raw, starts, ends, length), length)
            yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(around.view(np.int64))], names=["core", "around"])

    return docs.select("text").mapInArrow(run, "core long, around long")


def _prints(raw: bytes, cut: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    span, digest = _core(length), xxhash.xxh3_64_intdigest
    places = list(zip(cut.tolist(), low.tolist(), high.tolist(), strict=True))
    core = np.fromiter((digest(raw[c : c + span]) for c, _, _ in places), np.uint64, len(places))
    around = np.fromiter((digest(raw[a : b + length], c - a) for c, a, b in places), np.uint64, len(places))
    return core, around


#: What a second reading of a text gives: a stretch that is known to repeat, or the surroundings of a cut to be compared.
_FOUND = "text_key binary, start int, stop int, core binary, near binary, front binary, back binary, low int, high int"


def _marked(raw: bytes, key: bytes, cut, low, high, prints, same: np.ndarray, length: int) -> list[tuple]:
    """Rows of ``_FOUND`` for a text's cuts with repeated cores; ``same`` tells whether the core's surroundings are all equal."""
    rows, runs, span = [], [], _core(length)
    for c, a, b, s, p in zip(cut.tolist(), low.tolist(), high.tolist(), same.tolist(), prints.tolist(), strict=True):
        if s:
            runs.append((a, b + length))
        else:
            front, back = raw[a:c], raw[c + span : b + length]
            near = _digest(raw[a : b + length], c - a)
            rows.append((key, c, None, _digest(raw[c : c + span]), near, front, back, c - b, c - a))
    return [(key, x, y, None, None, None, None, None, None) for x, y in _merged(runs)] + rows


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching stretches as one."""
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
    names = [part.split()[0] for part in _FOUND.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _read_again(docs: DataFrame, repeated: DataFrame, length: int, broadcast_bytes: int) -> DataFrame:
    """``_FOUND`` rows of all texts; ``repeated``: (core, same) for each core found more than once."""
    if repeated.count() * 9 <= broadcast_bytes:
        alike = packed_longs(repeated.filter("same"), "core")
        cores = np.sort(np.concatenate([alike, packed_longs(repeated.filter("not same"), "core")]))
        shared = docs.sparkSession.sparkContext.broadcast((cores, np.isin(cores, alike)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cores, same = shared.value
            for batch in slices(batches, "text", 1 << 20):
                texts = _bytes(batch)
                raw, starts, ends = _joined(texts)
                cut, low, high = cuts(raw, starts, ends, length)
                prints, _ = _prints(raw, cut, low, high, length)
                prints = prints.view(np.int64)
                at = np.minimum(np.searchsorted(cores, prints), max(len(cores) - 1, 0))
                hit = np.flatnonzero(cores[at] == prints) if len(cores) else np.zeros(0, np.int64)
                doc = np.searchsorted(starts, cut[hit], side="right") - 1
                hit, doc = hit[np.argsort(doc, kind="stable")], np.sort(doc)
                rows = []
                for d in np.unique(doc).tolist():
                    h, base = hit[doc == d], int(starts[d])
                    key = hashlib.md5(texts[d]).digest()
                    rows += _marked(texts[d], key, cut[h] - base, low[h] - base, high[h] - base, prints[h], same[at[h]], length)
                yield _as_batch(rows)

        return docs.select("text").mapInArrow(run, _FOUND)

    keyed = docs.select("text", F.unhex(F.md5("text")).alias("text_key"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            raw, starts, ends = _joined(_bytes(batch))
            cut, low, high = cuts(raw, starts, ends, length)
            doc = np.searchsorted(starts, cut, side="right") - 1
            core, _ = _prints(raw, cut, low, high, length)
            keys = batch.column(batch.schema.get_field_index("text_key")).take(pa.array(doc))
            places = [pa.array((x - starts[doc]).astype(np.int32)) for x in (cut, low, high)]
            yield pa.RecordBatch.from_arrays([keys, pa.array(core.view(np.int64)), *places], names=["text_key", "core", "cut", "low", "high"])

    # One reading of a text is enough; its row count is kept, so that equal rows still count as repeats.
    places = keyed.mapInArrow(parse, "text_key binary, core long, cut int, low int, high int").distinct()
    mine = places.join(repeated, "core").groupBy("text_key").agg(F.collect_list(F.struct("cut", "low", "high", "core", "same")).alias("places"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            rows = []
            lists = batch.column(batch.schema.get_field_index("places")).to_pylist()
            for text, places in zip(_bytes(batch), lists, strict=True):
                cut, low, high, core, same = (np.array([p[k] for p in places]) for k in ("cut", "low", "high", "core", "same"))
                rows += _marked(text, hashlib.md5(text).digest(), cut, low, high, core, same, length)
            yield _as_batch(rows)

    return keyed.join(stored(mine, "cut-places"), "text_key").select("text", "places").mapInArrow(mark, _FOUND)


def _rank(group: np.ndarray, texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the texts in each group, and how many bytes each has in common with the one before it (-1: another group)."""
    if width == 0:
        order = np.argsort(group, kind="stable")
        common = np.where(np.r_[True, group[order][1:] != group[order][:-1]], -1, 0)
        return order, common
    padded = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(-1, width)
    order = np.lexsort((padded.view(f"S{width}").ravel(), group))
    lines, of = padded[order], group[order]
    differ = lines[1:] != lines[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.r_[-1, np.where(of[1:] == of[:-1], common, -1)]


def repeated_windows(group: np.ndarray, front: list[bytes], back: list[bytes], low: np.ndarray, high: np.ndarray, tail: int) -> np.ndarray:
    """For every row and distance d, low <= d <= high, whether its window occurs in another row of the group: a matrix of rows by d.

    A window at distance d has the last d bytes of ``front``, the core and the first
    ``tail - d`` bytes of ``back``. Rows of a group are different surroundings of one core.
    """
    most = int(high.max()) if len(high) else 0
    hit = np.zeros((len(group), most + 1), bool)
    front_order, front_common = _rank(group, [f[::-1] for f in front], max(map(len, front), default=0))
    back_order, back_common = _rank(group, back, max(map(len, back), default=0))
    left, right = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
    for d in range(int(low.min()) if len(low) else 0, most + 1):
        rows = np.flatnonzero((low <= d) & (d <= high))
        if len(rows) < 2:
            continue
        left[front_order] = np.cumsum(front_common < d)
        right[back_order] = np.cumsum(back_common < tail - d)
        place = left[rows] * (len(group) + 1) + right[rows]
        _, inverse, count = np.unique(place, return_inverse=True, return_counts=True)
        hit[rows, d] = count[inverse] > 1
    return hit


def _compared(entries: DataFrame, tail: int) -> DataFrame:
    """(core, near, first, last): the distances of windows that other entries of the core share."""
    spread = entries.repartition(shuffle_partitions(entries.sparkSession), "core").sortWithinPartitions("core")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["core"]):
            bounds = group_starts(table, ["core"])
            group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            front, back = table.column("front").to_pylist(), table.column("back").to_pylist()
            low, high = table.column("low").to_numpy().astype(np.int64), table.column("high").to_numpy().astype(np.int64)
            hit = repeated_windows(group, front, back, low, high, tail)
            rows = np.flatnonzero(hit.any(axis=1))
            edge = np.diff(np.pad(hit[rows].astype(np.int8), ((0, 0), (1, 1))), axis=1)
            r, begin = np.nonzero(edge == 1)
            _, end = np.nonzero(edge == -1)
            near = table.column("near").combine_chunks().take(pa.array(rows[r]))
            core = table.column("core").combine_chunks().take(pa.array(rows[r]))
            yield pa.RecordBatch.from_arrays([core, near, pa.array(begin.astype(np.int32)), pa.array((end - 1).astype(np.int32))], names=["core", "near", "first", "last"])

    columns = entries.select("core", "near", "front", "back", "low", "high")
    return spread.select(*columns.columns).mapInArrow(run, "core binary, near binary, first int, last int")


_ENTRY = ["core", "near", "front", "back", "low", "high"]


def _parts(entries: DataFrame, tail: int) -> DataFrame:
    """The entries of crowded cores cut into parts of ``PART`` distances, each under a core of its own.

    A part's core takes in all text that its windows share, so entries of one part differ in
    fewer than ``PART`` bytes on either side. ``whole`` and ``entry`` name the entry, ``base`` the part's first distance.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for core, near, front, back, low, high in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                for k in range(low // PART, high // PART + 1):
                    base = k * PART
                    a, b = max(low, base), min(high, base + PART - 1)
                    shared = front[len(front) - base :] + b"|" + back[: max(tail - base - PART + 1, 0)]
                    before = front[len(front) - b : len(front) - base]
                    behind = back[max(tail - base - PART + 1, 0) : tail - a]
                    part = _digest(core + base.to_bytes(4, "little") + shared)
                    inner = _digest(bytes([a - base, b - base, len(before)]) + before + behind)
                    rows.append((part, inner, before, behind, a - base, b - base, core, near, base))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 9
            kinds = [pa.binary()] * 4 + [pa.int32()] * 2 + [pa.binary()] * 2 + [pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*_ENTRY, "whole", "entry", "base"])

    schema = "core binary, near binary, front binary, back binary, low int, high int, whole binary, entry binary, base int"
    return entries.select(*_ENTRY).mapInArrow(run, schema)


def _hits(found: DataFrame, tail: int, group: int) -> DataFrame:
    """(core, near, first, last): distances whose windows repeat, for every different surroundings of a core."""
    entries = stored(found.groupBy(*_ENTRY).agg(F.count("*").alias("n")), "surroundings")
    again = entries.filter("n > 1").select("core", "near", F.col("low").alias("first"), F.col("high").alias("last"))
    sizes = stored(entries.groupBy("core").agg(F.count("*").alias("entries")).filter("entries > 1"), "core-sizes")
    few = entries.join(sizes.filter(F.col("entries") <= group).select("core"), "core")
    hits = _compared(few.select(*_ENTRY), tail).union(again)
    crowded = sizes.filter(F.col("entries") > group).select("core")
    if crowded.take(1):
        parts = stored(_parts(entries.join(crowded, "core"), tail), "parts")
        different = stored(parts.groupBy(*_ENTRY).agg(F.count("*").alias("n")), "different-parts")
        equal = different.filter("n > 1").select("core", "near", F.col("low").alias("first"), F.col("high").alias("last"))
        shared = stored(_compared(different.select(*_ENTRY), PART - 1).union(equal), "part-hits")
        of_entry = parts.select("core", "near", "whole", "entry", "base").join(shared, ["core", "near"])
        back = of_entry.select(F.col("whole").alias("core"), F.col("entry").alias("near"), (F.col("base") + F.col("first")).alias("first"), (F.col("base") + F.col("last")).alias("last"))
        hits = hits.union(back)
    return stored(hits, "hits")


def repeats(docs: DataFrame, length: int = 400, text: str = "text", broadcast_bytes: int = 64 << 20, group: int = GROUP) -> DataFrame:
    """(text_key, runs): for each different text (by MD5) the stretches of bytes that windows of ``length`` bytes found elsewhere cover."""
    if length < REACH + WINDOW:
        raise ValueError(f"length must be at least {REACH + WINDOW}")
    slim = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    parsed = _parsed(slim, length).groupBy("core")
    counts = parsed.agg(F.count("*").alias("n"), (F.min("around") == F.max("around")).alias("same")).filter("n > 1")
    repeated = stored(counts.select("core", "same"), "repeated-cores")
    found = stored(_read_again(slim, repeated, length, broadcast_bytes), "cuts")
    known = found.filter("stop is not null").select("text_key", "start", "stop")
    unsure = found.filter("stop is null")
    hits = _hits(unsure, length - _core(length), group)
    placed = unsure.select("text_key", F.col("start").alias("cut"), "core", "near").join(hits, ["core", "near"])
    more = placed.select("text_key", (F.col("cut") - F.col("last")).alias("start"), (F.col("cut") - F.col("first") + length).alias("stop"))
    each = known.union(more).distinct()
    # A text has at most as many stretches as cuts, so a list is bounded by its length.
    return stored(each.groupBy("text_key").agg(F.collect_list(F.struct("start", "stop")).alias("runs")), "runs")


def dedup(docs: DataFrame, length: int = 400, text: str = "text", broadcast_bytes: int = 64 << 20, group: int = GROUP) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes).

    Every byte under a window of ``length`` bytes that also starts somewhere else is removed, the
    first copy too. Columns of these names are replaced, all others stay.
    """
    runs = repeats(docs, length, text, broadcast_bytes, group)
    size = runs.agg(F.coalesce(F.sum(F.size("runs") * 16 + 64), F.lit(0))).first()[0]
    names = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept")]
    keyed = docs.select(*names, F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("_text_key"))
    side = runs.select(F.col("text_key").alias("_text_key"), F.col("runs").alias("_runs"))
    side = F.broadcast(side) if size <= broadcast_bytes else side
    joined = keyed.join(side, "_text_key", "left").select(*names, "_runs")
    zero = F.lit(0).cast("long")
    schema = docs.select(*names, zero.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.lit(b"").alias("kept")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 8 << 20):
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            lists = batch.column(batch.schema.get_field_index("_runs")).to_pylist()
            sizes, removed, spans, kept = [], [], [], []
            for raw, found in zip(texts, lists, strict=True):
                raw = raw or b""
                gone = _merged([(x["start"], x["stop"]) for x in found or []])
                stay = [raw[a:b] for a, b in zip([0, *(y for _, y in gone)], [*(x for x, _ in gone), len(raw)], strict=True)]
                sizes.append(len(raw))
                removed.append(sum(y - x for x, y in gone))
                spans.append(len(gone))
                kept.append(b"".join(stay))
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns += [pa.array(x, pa.int64()) for x in (sizes, removed, spans)] + [pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(run, schema)
