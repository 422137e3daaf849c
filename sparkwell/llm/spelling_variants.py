"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Letters are dealt into groups of about equal weight, and a word becomes the vector of its
counts in each group. One inserted, deleted or replaced code point changes a vector by at
most one surplus and one deficit. The vectors form a trie, a level for each group; a search
walks down from the root depth first, following equal counts for free and spending a budget
of one surplus and one deficit. Words in the leaves that are reached are verified in full.
Of two different vectors, the word with the smaller count at the first level that differs is
the one that searches, so the first thing spent is always the surplus and each pair is found once.

The upper levels of the trie are Spark's: words go to the node of their first ``STEP`` levels and to
the nodes their budget reaches there. A node with few words is searched in a task; a larger one goes
``STEP`` levels deeper with all that has arrived, and words that share all counts meet in
tiles, so no task ever holds more than a tile of words and one of searchers.

Defined results: null words and words that are shorter or rarer than asked take no part; equal words
of the input add up; without words the answer is empty.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.shared import LOWER, UPPER, stored
from sparkwell.skew import attach_per_key

GROUPS = 16
STEP = 4
#: Words of a node, and searchers, that meet in one task.
MEMBERS, SEARCHERS = 4096, 16_384
#: Members times searchers that are compared at once at the end of a walk.
LEAF = 1 << 16
#: Words up to this many code points are compared as rows of a matrix, longer ones one by one.
ROW = 64
RUN = r"[A-Za-zÀ-ÿ]+"


def runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", pattern: str = RUN, least_length: int = 1) -> DataFrame:
    """(id, word): every run of letters of every text, A-Z lower-cased, null texts have none."""
    found = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(pattern), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(F.filter(found, lambda w: F.length(w) >= least_length)).alias("word"))


def counted(words: DataFrame, least_length: int = 6, least_n: int = 5) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    found = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return found.filter(F.col("n") >= least_n)


def letter_groups(vocabulary: DataFrame, groups: int = GROUPS, most_letters: int = 4096) -> np.ndarray:
    """The group of each code point: the commonest letters dealt to the lightest group, all others by their number."""
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''")
    common = letters.groupBy("letter").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "letter").limit(most_letters).collect()
    table = (np.arange(0x110000) % groups).astype(np.uint8)
    weight = [0] * groups
    for r in common:
        lightest = weight.index(min(weight))
        table[ord(r["letter"])] = lightest
        weight[lightest] += r["n"]
    return table


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each word, a row of zeros for words longer than a row, and the words' lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = int(sizes[sizes <= ROW].max(initial=1))
    raw = "".join([w.ljust(width, "\0") if len(w) <= ROW else "\0" * width for w in words]).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).reshape(-1, width), sizes


def vectors(words: list[str], table: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Counts by letter group, up to 255: cut off there, counts still differ by no more than their words do."""
    codes, sizes = code_points(words)
    group = table[codes]
    group[np.arange(codes.shape[1]) >= np.minimum(sizes, codes.shape[1])[:, None]] = 255
    made = np.stack([np.minimum((group == g).sum(axis=1), 255) for g in range(groups)], axis=1).astype(np.uint8)
    for i in np.flatnonzero(sizes > ROW).tolist():
        found = Counter(table[ord(c)] for c in words[i])
        made[i] = [min(found[g], 255) for g in range(groups)]
    return made


def reached(vector: np.ndarray, spent: np.ndarray, start: int, stop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, counts at levels up to ``stop``, budget spent) of every node that rows can reach from level ``start``.

    ``vector`` holds the counts on the way so far and, from ``start`` on, the word's own.
    """
    every = np.arange(len(vector))
    yield every, vector[:, :stop], spent
    for i in range(start, stop):
        more = every[(spent == 0) & (vector[:, i] < 255)]
        up = vector[more, :stop].copy()
        up[:, i] += 1
        yield more, up, np.ones(len(more), np.int32)
        for j in range(i + 1, stop):
            both = np.flatnonzero(up[:, j] > 0)
            down = up[both].copy()
            down[:, j] -= 1
            yield more[both], down, np.full(len(both), 2, np.int32)
        less = every[(spent == 1) & (vector[:, i] > 0)]
        down = vector[less, :stop].copy()
        down[:, i] -= 1
        yield less, down, np.full(len(less), 2, np.int32)


def _arrivals(rows: DataFrame, table, start: int, stop: int) -> DataFrame:
    """(node, spent, word, n): words at home (nothing spent) and searchers at the nodes ``stop`` levels deep."""
    first = start == 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            words = batch.column(batch.schema.get_field_index("word"))
            n = batch.column(batch.schema.get_field_index("n"))
            vector = vectors(words.to_pylist(), table.value)
            spent = np.zeros(len(vector), np.int32)
            if not first:
                spent = batch.column(batch.schema.get_field_index("spent")).to_numpy().astype(np.int32)
                nodes = batch.column(batch.schema.get_field_index("node")).to_pylist()
                vector[:, :start] = np.frombuffer(b"".join(nodes), np.uint8).reshape(-1, start)
            for at, path, cost in reached(vector, spent, start, stop):
                if len(at):
                    keys = pa.array([p.tobytes() for p in np.ascontiguousarray(path)], pa.binary())
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays([keys, pa.array(cost.astype(np.int32)), words.take(take), n.take(take)], names=["node", "spent", "word", "n"])

    return rows.mapInArrow(run, "node binary, spent int, word string, n long")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes one word of the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


class Node:
    """The part of the trie below a node, and a depth-first walk of many searchers through it."""

    def __init__(self, members: list[str], searchers: list[str], spent: np.ndarray, table: np.ndarray, depth: int):
        own = vectors(members, table)
        order = np.lexsort(own.T[::-1])
        self.members = [members[i] for i in order.tolist()]
        self.counts = own[order].astype(np.int16)
        self.searchers = searchers
        self.sought = vectors(searchers, table).astype(np.int16)
        self.depth = depth
        self.spent = spent
        self.codes, self.sizes = code_points([*self.members, *searchers])
        self.place = order
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(member, searcher) places of all pairs one edit apart."""
        if self.members and self.searchers:
            self._descend(0, len(self.members), self.depth, np.arange(len(self.searchers)), self.spent)
        members, searchers = (np.concatenate([f[i] for f in self.found] or [np.zeros(0, np.int64)]) for i in (0, 1))
        return self.place[members], searchers

    def _descend(self, low: int, high: int, level: int, who: np.ndarray, spent: np.ndarray) -> None:
        if (high - low) * len(who) <= LEAF or level == GROUPS:
            block = max(1, LEAF // len(who))
            for a in range(low, high, block):
                self._leaf(a, min(high, a + block), level, who, spent)
            return
        counts = self.counts[low:high, level]
        cuts = [0, *(np.flatnonzero(np.diff(counts)) + 1).tolist(), len(counts)]
        wanted = self.sought[who, level]
        for a, b in zip(cuts, cuts[1:], strict=False):
            over = counts[a] - wanted
            on = (over == 0) | ((over == 1) & (spent == 0)) | ((over == -1) & (spent == 1))
            if on.any():
                self._descend(low + a, low + b, level + 1, who[on], (spent + (over != 0))[on])

    def _leaf(self, low: int, high: int, level: int, who: np.ndarray, spent: np.ndarray) -> None:
        """Spend what is left of the budget on the remaining levels at once, then verify the words."""
        fits = np.ones((high - low, len(who)), bool)
        left = np.broadcast_to(spent, fits.shape).copy()
        for i in range(level, GROUPS):
            over = self.counts[low:high, i][:, None] - self.sought[who, i]
            fits &= (over == 0) | ((over == 1) & (left == 0)) | ((over == -1) & (left == 1))
            left += over != 0
        member, at = np.nonzero(fits)
        if not len(member):
            return
        same = left[member, at] == 0
        member, at = member + low, who[at]
        near = np.abs(self.sizes[member] - self.sizes[len(self.members) + at]) <= 1
        member, at, same = member[near], at[near], same[near]
        for a in range(0, len(member), LEAF):
            part = slice(a, a + LEAF)
            right = self._verified(member[part], at[part], same[part])
            if right.any():
                self.found.append((member[part][right], at[part][right]))

    def _verified(self, member: np.ndarray, at: np.ndarray, same: np.ndarray) -> np.ndarray:
        """One edit apart; words with the same counts meet twice, so only the smaller one's search counts."""
        other = len(self.members) + at
        swap = self.sizes[member] > self.sizes[other]
        a, b = np.where(swap, other, member), np.where(swap, member, other)
        short, long = self.codes[a], self.codes[b]
        differ = short != long
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), differ.shape[1])
        shifted = ((short[:, :-1] != long[:, 1:]) & (np.arange(differ.shape[1] - 1) >= first[:, None])).any(axis=1)
        right = np.where(self.sizes[a] == self.sizes[b], differ.sum(axis=1) == 1, ~shifted)
        for i in np.flatnonzero(self.sizes[b] > ROW).tolist():
            right[i] = one_edit(self.members[member[i]], self.searchers[at[i]])
        for i in np.flatnonzero(right & same).tolist():
            right[i] = self.searchers[at[i]] < self.members[member[i]]
        return right


def near_words(vocabulary: DataFrame, members: int = MEMBERS, searchers: int = SEARCHERS) -> DataFrame:
    """(a, a_n, b, b_n): every pair of words one edit apart, once. ``vocabulary`` (word, n) must be a stored table without repeats."""
    table = vocabulary.sparkSession.sparkContext.broadcast(letter_groups(vocabulary))
    pairs = []
    rows = vocabulary
    for depth in range(STEP, GROUPS + 1, STEP):
        arrived = stored(_arrivals(rows, table, depth - STEP, depth), "trie-arrivals")
        at_home = F.count_if(F.col("spent") == 0)
        sizes = arrived.groupBy("node").agg(at_home.alias("homes"), F.count("*").alias("all")).filter("homes > 0")
        sizes = stored(sizes, "trie-nodes")
        small = sizes if depth == GROUPS else sizes.filter(F.col("homes") <= members)
        pairs.append(stored(_searched(attach_per_key(arrived, small, "node"), table, depth, members, searchers), "near-words"))
        large = sizes.filter(F.col("homes") > members)
        if depth == GROUPS or not large.take(1):
            break
        rows = attach_per_key(arrived, large.select("node"), "node")
    found = pairs[0]
    for more in pairs[1:]:
        found = found.unionByName(more)
    return found


def _searched(arrived: DataFrame, table, depth: int, members: int, searchers: int) -> DataFrame:
    """Pairs inside nodes ``depth`` levels deep: each tile of a node's words meets each tile of all that has arrived there."""
    tiles = F.ceil(F.col("homes") / members).cast("int")
    turns = F.ceil(F.col("all") / searchers).cast("int")
    draw = F.xxhash64("word")
    at_home = arrived.filter("spent = 0").withColumn("tile", F.pmod(draw, tiles)).withColumn("turn", F.explode(F.sequence(F.lit(0), turns - 1)))
    seeking = arrived.withColumn("turn", F.pmod(draw, turns)).withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1)))
    columns = ["node", F.col("tile").cast("int"), F.col("turn").cast("int"), "spent", "word", "n"]
    both = at_home.select(*columns, F.lit(True).alias("home")).unionByName(seeking.select(*columns, F.lit(False).alias("home")))

    def search(group: pa.Table) -> pa.Table:
        home = group.column("home").to_numpy()
        mine, theirs = group.filter(pa.array(home)), group.filter(pa.array(~home))
        spent = theirs.column("spent").to_numpy().astype(np.int64)
        node = Node(mine.column("word").to_pylist(), theirs.column("word").to_pylist(), spent, table.value, depth)
        a, b = (pa.array(x) for x in node.pairs())
        columns = [mine.column("word").take(a), mine.column("n").take(a), theirs.column("word").take(b), theirs.column("n").take(b)]
        return pa.Table.from_arrays(columns, names=["a", "a_n", "b", "b_n"])

    return both.groupBy("node", "tile", "turn").applyInArrow(search, "a string, a_n long, b string, b_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last form that forms lead to. A form is far more frequent than its word, so there are no rings."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        new = stored(new, "roots")
        at = new.select("word", "root")
        if not new.filter("moved").take(1):
            return at


def variants(vocabulary: DataFrame, times: int = 5, **tiles) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n): a word's form is its most frequent near word, if that is ``times`` as frequent."""
    words = stored(vocabulary.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    found = near_words(words, **tiles)
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("order"), "other"))
    near = found.select(F.inline(sides)).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    told = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(-F.col("best.order") >= times * F.col("n"), F.col("best")).alias("best")
    )
    told = stored(told.select("word", "n", "n_near", F.col("best.other").alias("form"), (-F.col("best.order")).alias("form_n")), "forms")
    lead = roots(told.filter("form is not null"))
    return told.join(lead, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
