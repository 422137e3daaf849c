"""What the operators share: written intermediates, batches, words, hashes and connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwell.storage import new_path

#: White space, and a word.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
WORD_BYTES = rb"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps don't repeat its work or lose it with an executor."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Batches = Iterator[pa.RecordBatch]


def leaving_nothing(run: Callable[[Batches], Batches], *forget: Callable[[], None]) -> Callable[[Batches], Batches]:
    """``run`` for tasks whose worker goes on to other stages: at its end caches are emptied and memory goes back to the system."""

    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            for clear in forget:
                clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library, which has no such call
                pass

    return wrapped


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``max_bytes``, so that long texts don't add up in memory.

    A single longer text is a batch of its own.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes) // max_bytes
        starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            yield batch.slice(a, b - a)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold only whole groups; the rows must come sorted by ``keys``.

    Memory holds a batch and the group that is still open, so groups must be of bounded size.
    """
    kept: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(batch.schema.get_field_index(k))[row].as_py() for k in keys)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        last = key(batch, batch.num_rows - 1)
        if kept and key(kept[-1], 0) == last:
            kept.append(batch)
            continue
        low, high = 0, batch.num_rows - 1
        while low < high:
            middle = (low + high) // 2
            if key(batch, middle) == last:
                high = middle
            else:
                low = middle + 1
        kept.append(batch.slice(0, low))
        table = pa.Table.from_batches(kept)
        if table.num_rows:
            yield table
        kept = [batch.slice(low)]
    if kept:
        yield pa.Table.from_batches(kept)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """The first row of each group, and the number of rows."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for k in keys:
        column = table.column(k).combine_chunks()
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(new), table.num_rows)


def fixed_bytes(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A binary column of equally long values as a matrix of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def packed_longs(rows: DataFrame, column: str) -> np.ndarray:
    """A column of long values on the driver, eight bytes each; the caller has checked how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            yield pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary())], names=["packed"])

    parts = [bytes(r["packed"]) for r in rows.select(column).mapInArrow(run, "packed binary").toLocalIterator()]
    return np.sort(np.frombuffer(b"".join(parts), "<i8"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the component is its smallest node.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so paths halve; a round writes one table. All joins are between plain shuffles,
    which adaptive execution can split when a node has very many edges; labels never reach
    the driver.
    """
    forward = edges.select("a", "b").filter("a <> b")
    both = stored(forward.union(forward.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        nearest = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        moved = labels.join(nearest, "node").select("node", "component", F.least("component", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("lowest"))
        new = stored(
            moved.join(jump, "low").select(
                "node", F.least("low", "lowest").alias("component"), (F.least("low", "lowest") < F.col("component")).alias("changed")
            ),
            "labels",
        )
        labels = new.select("node", "component")
        if not new.filter("changed").take(1):
            return labels
