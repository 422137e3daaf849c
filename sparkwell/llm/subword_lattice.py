"""Language-model scores from a lattice of subword pieces.

The pieces and their first weights are those of an existing tokenizer model. A word, with
the white-space marker in front, is the lattice of all its segmentations into pieces; a
forward recursion in log space sums over all of them, so the probability is that of the word and
not of one tokenisation. Code points without a piece go through byte pieces. The training documents
re-estimate the weights by expected piece counts (forward-backward over word counts) and add one
edge a known word, for the whole word, by its discounted count; what the discount frees goes through the
pieces. Each class of training documents (here: languages) has such a model, beside one of all of them; a
document's probability is the sum over classes of prior times its tokens, so it is a marginal over classes
and segmentations. All of it adds up to at most 1 over all texts.

Tokens are words and one end of the text. Words are counted, and the lattice is run, once for each
different word. A bounded number of the most frequent words goes to the tasks with their scores; what else a
document holds is joined by word, so no frequent word ever meets a shuffle. The driver
holds piece weights by class, sums by class and those frequent words.

Defined results: null counts as the empty text, which has one token, its end; each row is scored for
itself, repeated rows included; a null id counts as empty text in the choice of training documents; without training documents
every token is unknown and the model has the first weights alone; without rows the answer is empty.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwell.llm.sentencepiece_tokens import BYTE, MARK, NORMAL, UNIGRAM, Model
from sparkwell.llm.shared import slices, stored

#: Stands for the marker, so that the same character inside a word is one like any other.
MARKER = 0x110000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
NEVER = -1e30
#: Expected counts are rounded to this share, so sums don't depend on their order.
UNIT = 1 << 16
DISCOUNT = 0.75
#: Cells of a block of words that is worked on at once, and words that are sorted into such blocks.
CELLS = 1 << 22
WORDS = 1 << 16
#: Bits of a hashed window that tell most windows without a piece.
SIEVE = 20


def learns(id_col: str, folds: int = 7, aside: int = 2) -> Column:
    """Whether a document is one to learn from."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) != aside


class Pieces:
    """The pieces of a model file as a lookup of code-point windows, and their first weights."""

    def __init__(self, raw: bytes):
        model = Model.read(raw)
        usable = [(p, s) for p, s, kind in model.pieces if kind == NORMAL and p != "" and MARK not in p[1:]]
        codes = [[MARKER if c == MARK and i == 0 else ord(c) for i, c in enumerate(p)] for p, _ in usable]
        self.n = len(usable) + 256
        self.longest = max(map(len, codes), default=1)
        self.table: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for size in range(1, self.longest + 1):
            at = np.array([i for i, c in enumerate(codes) if len(c) == size], np.int64)
            hashed = self._windows(np.array([codes[i] for i in at.tolist()], np.uint64).reshape(-1, size))
            order = np.argsort(hashed)
            sieve = np.zeros(1 << SIEVE, bool)
            sieve[self._sieved(hashed)] = True
            self.table.append((hashed[order], at[order].astype(np.int32), sieve))
        scores = np.array([s for _, s in usable])
        if model.kind == UNIGRAM:
            weight = np.exp(scores - scores.max(initial=0.0))
        else:  # scores of a BPE model are ranks
            weight = 1.0 / (10.0 + np.argsort(np.argsort(-scores, kind="stable"), kind="stable"))
        byte = 0.04 if any(kind == BYTE for *_, kind in model.pieces) else 0.01
        self.first = np.log(np.r_[(1 - byte) * weight / max(weight.sum(), 1e-300), np.full(256, byte / 256)])

    @staticmethod
    def _windows(codes: np.ndarray) -> np.ndarray:
        made = np.zeros(len(codes), np.uint64)
        for column in codes.T:
            made = made * MULTIPLIER + column + np.uint64(1)
        return made

    @staticmethod
    def _sieved(hashed: np.ndarray) -> np.ndarray:
        return ((hashed * MULTIPLIER) >> np.uint64(64 - SIEVE)).astype(np.int64)

    def edges(self, codes: np.ndarray) -> np.ndarray:
        """(end, size, word): the piece of ``size + 1`` code points that ends after code point ``end``, or -1."""
        words, width = codes.shape
        found = np.full((width, min(self.longest, width), words), -1, np.int32)
        hashed = np.zeros(codes.shape, np.uint64)
        for size in range(found.shape[1]):
            hashed = hashed[:, : width - size] * MULTIPLIER + codes[:, size:].astype(np.uint64) + np.uint64(1)
            known, piece, sieve = self.table[size]
            if len(known):
                word, start = np.nonzero(sieve[self._sieved(hashed)])
                wanted = hashed[word, start]
                spot = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                found[start + size, size, word] = np.where(known[spot] == wanted, piece[spot], -1)
        return found

    def spelled(self, code: int) -> list[int]:
        """The byte pieces of a code point."""
        raw = MARK.encode() if code == MARKER else chr(code).encode("utf-8", "surrogatepass")
        return [self.n - 256 + b for b in raw]


def _added(terms: np.ndarray) -> np.ndarray:
    """log(sum(exp)) over the second axis."""
    top = terms.max(axis=1)
    return top + np.log(np.exp(terms - top[:, None]).sum(axis=1))


@dataclass
class Lattice:
    """All segmentations of words of one length: (word, code point) with the marker in front."""

    pieces: Pieces
    codes: np.ndarray
    edges: np.ndarray | None = None

    def __post_init__(self):
        if self.edges is None:
            self.edges = self.pieces.edges(self.codes)
        self.lone = np.argwhere(self.edges[:, 0] < 0)
        self.unknown = self.codes[self.lone[:, 1], self.lone[:, 0]]

    def of(self, words: np.ndarray) -> Lattice:
        """The lattice of some of the words; no window is looked up again."""
        return self if len(words) == len(self.codes) else Lattice(self.pieces, self.codes[words], self.edges[:, :, words])

    def _by_bytes(self, weights: np.ndarray) -> np.ndarray:
        """(class, code point, word): the weight of code points that have no piece."""
        made = np.full((len(weights), *self.edges.shape[::2]), NEVER)
        if len(self.lone):
            kinds, at = np.unique(self.unknown, return_inverse=True)
            cost = np.stack([weights[:, self.pieces.spelled(c)].sum(axis=1) for c in kinds.tolist()], axis=1)
            made[:, self.lone[:, 0], self.lone[:, 1]] = cost[:, at]
        return made

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """(class, place, word): log probability of what comes before each place; the last place has whole words."""
        width = len(self.edges)
        byte = self._by_bytes(weights)
        padded = np.concatenate([weights, np.full((len(weights), 1), NEVER)], axis=1)
        reach = np.full((len(weights), width + 1, self.edges.shape[2]), NEVER)
        reach[:, 0] = 0.0
        for end in range(width):
            sizes = min(end + 1, self.edges.shape[1])
            edge = padded[:, self.edges[end, :sizes]]
            edge[:, 0] = np.maximum(edge[:, 0], byte[:, end])
            reach[:, end + 1] = _added(edge + reach[:, end - sizes + 1 : end + 1][:, ::-1])
        return reach

    def expected(self, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """(column of counts, piece): expected uses, each word's share rounded to units; ``weights`` of one class."""
        weights = weights[None]
        width, most, words = self.edges.shape
        reach, byte = self.forward(weights)[0], self._by_bytes(weights)[0]
        padded = np.append(weights[0], NEVER)
        rest = np.full((width + 1, words), NEVER)
        rest[width] = 0.0
        made = np.zeros((counts.shape[1], self.pieces.n), np.int64)
        used, uses_of = [], [[] for _ in made]
        for start in range(width - 1, -1, -1):
            sizes = min(width - start, most)
            piece = np.stack([self.edges[start + s, s] for s in range(sizes)])
            edge = padded[piece]
            edge[0] = np.maximum(edge[0], byte[start])
            onward = edge + rest[start + 1 : start + 1 + sizes]
            rest[start] = _added(onward[None])[0]
            size, word = np.nonzero(piece >= 0)
            share = np.exp(reach[start, word] + onward[size, word] - reach[width, word])
            used.append(piece[size, word])
            lone = np.flatnonzero(piece[0] < 0)
            of_lone = np.exp(reach[start, lone] + onward[0, lone] - reach[width, lone])
            for column in range(counts.shape[1]):
                uses_of[column].append(np.rint(share * counts[word, column] * UNIT))
                by_bytes = np.rint(of_lone * counts[lone, column] * UNIT)
                for i in np.flatnonzero(by_bytes > 0).tolist():
                    np.add.at(made[column], self.pieces.spelled(int(self.codes[lone[i], start])), int(by_bytes[i]))
        for column, uses in enumerate(uses_of):
            made[column] += np.bincount(np.concatenate(used), np.concatenate(uses), self.pieces.n).astype(np.int64)
        return made


def lattices(pieces: Pieces, words: list[str]) -> Iterator[tuple[np.ndarray, Lattice]]:
    """(places, lattice) of words of one length at a time, in blocks of bounded size."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        if not len(group):
            continue
        width = int(sizes[group[0]]) + 1
        block = max(1, CELLS // (width * min(width, pieces.longest)))
        for at in range(0, len(group), block):
            part = group[at : at + block]
            raw = "".join([words[i] for i in part.tolist()]).encode("utf-32-le", "surrogatepass")
            codes = np.frombuffer(raw, np.uint32).reshape(len(part), width - 1).astype(np.int64)
            yield part, Lattice(pieces, np.concatenate([np.full((len(part), 1), MARKER), codes], axis=1))


@dataclass
class Scorer:
    """A trained model: piece weights by class, priors, and how counts become probabilities."""

    raw: bytes
    names: list[str]
    weights: np.ndarray
    prior: np.ndarray
    tokens: np.ndarray
    ends: np.ndarray
    types: np.ndarray
    distinct: int

    def words(self, pieces: Pieces, words: list[str], counts: np.ndarray) -> np.ndarray:
        """(word, class): log probability of each word; ``counts`` (word, class) in the training documents."""
        made = np.zeros((len(words), len(self.weights)))
        for at, lattice in lattices(pieces, words):
            made[at] = lattice.forward(self.weights)[:, -1].T
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(counts - DISCOUNT, 0.0))
        return np.logaddexp(whole, made + np.log(DISCOUNT * self.types + 1.0)) - np.log(self.tokens + 2.0)

    def end(self) -> np.ndarray:
        return np.log(self.ends + 1.0) - np.log(self.tokens + 2.0)


def word_counts(docs: DataFrame, id_col: str, text: str, class_col: str | None, names: list[str]) -> DataFrame:
    """(word, n, c0, c1, ...): occurrences in all documents, in all training documents, and in those of each class."""
    spot = F.lit(0)
    for i, name in enumerate(names, 1):
        spot = F.when(F.col(class_col).cast("string") == name, i).otherwise(spot)
    slim = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.when(learns(id_col), spot).otherwise(F.lit(-1)).alias("spot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found: dict[int, Counter] = {}
            texts = batch.column(0).cast(pa.binary())
            for raw, k in zip(texts, batch.column(1).to_pylist(), strict=True):
                found.setdefault(k, Counter()).update(raw.as_py().lower().split())
            for k, counter in found.items():
                words = pa.array(list(counter), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([words, pa.array(np.full(len(counter), k, np.int32)), pa.array(list(counter.values()), pa.int64())], names=["word", "spot", "n"])

    each = slim.mapInArrow(run, "word string, spot int, n long")
    sums = [F.sum("n").alias("n"), F.sum(F.when(F.col("spot") >= 0, F.col("n")).otherwise(0)).alias("c0")]
    sums += [F.sum(F.when(F.col("spot") == i, F.col("n")).otherwise(0)).alias(f"c{i}") for i in range(1, len(names) + 1)]
    return each.groupBy("word").agg(*sums)


def _matrix(batch: pa.RecordBatch, classes: int) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(f"c{i}")).to_numpy() for i in range(classes)], axis=1)


def _together(batches: Iterator[pa.RecordBatch], rows: int = WORDS, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches put together up to about that many rows or bytes, as words of one length are worked on together."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def expected_uses(pieces: Pieces, words: list[str], counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(class, piece): expected uses by the words' counts (word, class); windows are looked up once, for all classes."""
    made = np.zeros(weights.shape, np.int64)
    shared = (weights == weights[0]).all()
    for part, lattice in lattices(pieces, words):
        c = counts[part]
        for columns in [slice(None)] if shared else [slice(k, k + 1) for k in range(len(weights))]:
            some = np.flatnonzero(c[:, columns].any(axis=1))
            if len(some):
                made[columns] += lattice.of(some).expected(weights[columns][0], c[some][:, columns])
    return made


def _expected(counts: DataFrame, raw: bytes, weights: np.ndarray) -> np.ndarray:
    """(class, piece): expected uses of every piece in the training documents of each class; one forward pass a set of equal weights."""
    sent = counts.sparkSession.sparkContext.broadcast((raw, weights))
    classes = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, weights = sent.value
        pieces, made = Pieces(raw), np.zeros(weights.shape, np.int64)
        for batch in _together(batches):
            made += expected_uses(pieces, batch.column(batch.schema.get_field_index("word")).to_pylist(), _matrix(batch, classes), weights)
        k, piece = np.nonzero(made)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(made[k, piece])], names=["k", "piece", "uses"])

    each = counts.filter("c0 > 0").mapInArrow(run, "k int, piece int, uses long")
    made = np.zeros(weights.shape)
    for r in each.groupBy("k", "piece").agg(F.sum("uses").alias("uses")).collect():
        made[r["k"], r["piece"]] = r["uses"] / UNIT
    return made


def train(docs: DataFrame, counts: DataFrame, names: list[str], raw: bytes, id_col: str, class_col: str | None, rounds: int = 2, strength: float = 200.0) -> Scorer:
    """Piece weights by ``rounds`` of expectation-maximisation from the vocabulary's own, which count as ``strength`` pieces."""
    classes = len(names) + 1
    own = [F.sum(f"c{i}").alias(f"n{i}") for i in range(classes)] + [F.count_if(F.col(f"c{i}") > 0).alias(f"v{i}") for i in range(classes)]
    told = counts.agg(*own).first()
    learned = docs.filter(learns(id_col))
    per = {r[0]: r[1] for r in learned.groupBy(F.col(class_col).cast("string")).count().filter(F.col(class_col).isin(names)).collect()} if names else {}
    ends = np.array([learned.count(), *(per.get(n, 0) for n in names)], float)
    words = np.array([told[f"n{i}"] or 0 for i in range(classes)], float)
    pieces = Pieces(raw)
    weights = np.tile(pieces.first, (classes, 1))
    for _ in range(rounds if told["n0"] else 0):
        uses = _expected(counts, raw, weights) + strength * np.exp(pieces.first)
        weights = np.log(uses / uses.sum(axis=1, keepdims=True))
    left = max(0.0, ends[0] - ends[1:].sum())
    prior = np.log(np.r_[left, ends[1:]] + 1.0) - math.log(ends[0] + classes)
    types = np.array([told[f"v{i}"] or 0 for i in range(classes)], float)
    return Scorer(raw, names, weights, prior, words + ends, ends, types, int(types[0]) + (ends[0] > 0))


def class_names(docs: DataFrame, id_col: str, class_col: str | None, most_classes: int) -> list[str]:
    """The classes with most training documents; all others are in the model of the whole corpus only."""
    if class_col is None:
        return []
    each = docs.filter(learns(id_col) & F.col(class_col).isNotNull()).groupBy(F.col(class_col).cast("string").alias("name")).count()
    return [r["name"] for r in each.orderBy(F.desc("count"), "name").limit(most_classes).collect()]


def scored_words(counts: DataFrame, model: Scorer) -> DataFrame:
    """(word, n, c0, p): each word's log probability by class."""
    sent = counts.sparkSession.sparkContext.broadcast(model)
    classes = len(model.names) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        pieces = Pieces(model.raw)
        for batch in _together(batches):
            words = batch.column(batch.schema.get_field_index("word"))
            found = model.words(pieces, words.to_pylist(), _matrix(batch, classes))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), classes).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([words, *(batch.column(batch.schema.get_field_index(c)) for c in ("n", "c0")), lists], names=["word", "n", "c0", "p"])

    return counts.mapInArrow(run, "word string, n long, c0 long, p array<double>")


def frequent_from(words: DataFrame, most: int) -> int:
    """The least power of two such that no more than ``most`` words are that frequent."""
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int").alias("power")
    each = {r["power"]: r["count"] for r in words.groupBy(power).count().collect()}
    bound, room = 1 << 62, most
    for p in sorted(each, reverse=True):
        room -= each[p]
        if room < 0:
            break
        bound = 1 << p
    return bound


def score(docs: DataFrame, words: DataFrame, model: Scorer, id_col: str = "doc_id", text: str = "text", broadcast_words: int = 400_000, word_bytes: int = 64) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; ``words`` is a stored :func:`scored_words`."""
    classes = len(model.names) + 1
    often = (F.col("n") >= frequent_from(words, broadcast_words)) & (F.octet_length("word") <= word_bytes)
    table = words.filter(often).select("word", "c0", "p").toArrow()
    known = dict(zip(table.column("word").cast(pa.binary()).to_pylist(), range(table.num_rows), strict=True))
    p = table.column("p").combine_chunks()
    sent = docs.sparkSession.sparkContext.broadcast((known, table.column("c0").to_numpy(), p.flatten().to_numpy().reshape(-1, classes)))
    slim = docs.select(F.col(id_col).alias("id"), (~learns(id_col)).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType)])
    kinds = {"row": "long", "held_out": "boolean", "n_tokens": "long", "known": "long", "base": "double", "p": "array<double>", "word": "array<string>", "times": "array<int>"}
    for name, kind in kinds.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, c0, p = sent.value
        place = known.get
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text", 4 << 20):
            tokens, seen, base, sums, rare, times = [], [], [], [], [], []
            for raw in batch.column(2).cast(pa.binary()).to_pylist():
                found = Counter(raw.lower().split())
                at = np.fromiter(map(place, found, repeat(-1)), np.int64, len(found))
                n = np.fromiter(found.values(), np.int64, len(found))
                here = at >= 0
                spot, m = at[here], n[here]
                tokens.append(int(n.sum()) + 1)
                seen.append(int(m[c0[spot] > 0].sum()))
                base.append(float(m @ np.log10(c0[spot] + 1.0)))
                sums.append((m @ p[spot]).tolist())
                rare.append(list(compress(found, ~here)))
                times.append(n[~here].astype(np.int32))
            size = batch.num_rows
            columns = [batch.column(0), pa.array(np.arange(row, row + size)), batch.column(1), pa.array(tokens, pa.int64()), pa.array(seen, pa.int64())]
            columns += [pa.array(base, pa.float64()), pa.array(sums, pa.list_(pa.float64()))]
            columns += [pa.array(rare, pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32()))]
            row += size
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    told = stored(slim.mapInArrow(run, schema), "scored-documents")
    rare = told.select("row", F.inline(F.arrays_zip("word", "times"))).join(words.filter(~often).select("word", "c0", "p"), "word")
    sums = [F.sum(F.when(F.col("c0") > 0, F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c0") + 1.0)).alias("more_base")]
    sums += [F.sum(F.col("times") * F.col("p")[k]).alias(f"p{k}") for k in range(classes)]
    both = told.drop("word", "times").join(rare.groupBy("row").agg(*sums), "row", "left")
    more = lambda c: F.coalesce(F.col(c), F.lit(0))
    trained = int(model.tokens[0])
    end = math.log10(model.ends[0] + 1.0)
    base = F.col("base") + more("more_base") + end - F.col("n_tokens") * math.log10(trained + model.distinct + 1)
    each = F.array(*[F.col("p")[k] + more(f"p{k}") + float(model.prior[k] + model.end()[k]) for k in range(classes)])
    return both.withColumn("by_class", each).select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + more("more_known") + int(model.ends[0] > 0)).alias("n_known"),
        F.lit(trained).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        ((F.array_max("by_class") + F.log(F.aggregate(F.transform("by_class", lambda x: F.exp(x - F.array_max("by_class"))), F.lit(0.0), lambda a, x: a + x))) / math.log(10)).alias("score"),
    )


def log_probabilities(docs: DataFrame, raw: bytes, id_col: str = "doc_id", text: str = "text", class_col: str | None = "lang", most_classes: int = 8, rounds: int = 2, **more) -> DataFrame:
    """Train on the documents that :func:`learns` chooses and score all of them, with the add-one score of their tokens beside it."""
    names = class_names(docs, id_col, class_col, most_classes)
    counts = stored(word_counts(docs, id_col, text, class_col, names), "word-counts")
    model = train(docs, counts, names, raw, id_col, class_col, rounds)
    return score(docs, stored(scored_words(counts, model), "word-scores"), model, id_col, text, **more)
