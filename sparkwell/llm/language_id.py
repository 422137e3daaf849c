"""Language ID by error-correcting output codes.

Every language has a codeword. For each bit of the code a binary classifier over hashed
character n-grams separates the languages with a 1 from those with a 0; its weights are
the log ratios of mean n-gram frequencies, scaled so that both sides lie about one unit
from the border. A text gets the language whose codeword costs least, where each bit's
exponential loss is weighted by how often that classifier was right on that language.
Score is the share of the chosen language in the normalised costs; a text whose score or lead
is small is flagged ambiguous.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties go to the
language that comes first by name; every row is predicted by its text alone, whole; with no
labelled text every answer is ``und``; with one language the answer is that language, score 1.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.shared import leaving_nothing, slices, stored

UNDETERMINED = "und"
BUCKETS = 1 << 13
SIZES = (1, 2, 3)


def _letter_table() -> np.ndarray:
    """For each code point of the basic plane: its lower case if it is a letter, else a space."""
    table = np.full(1 << 16, 32, np.uint32)
    for code in range(1 << 16):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_letters: list[np.ndarray] = []


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as numbers, each run of anything else as one space."""
    if not _letters:
        _letters.append(_letter_table())
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _letters[0][np.minimum(raw, 0xFFFF)]
    for at in np.flatnonzero(raw > 0xFFFF).tolist():
        low[at] = raw[at] if chr(int(raw[at])).isalpha() else 32
    return low[(low != 32) | (np.r_[np.uint32(0), low[:-1]] != 32)] if len(low) else low


def frequencies(texts: list[str]) -> np.ndarray:
    """A row for each text: relative frequencies of its hashed n-grams; all 0 for a text without a letter."""
    found = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in enumerate(texts):
        codes = _codes(text).astype(np.uint64)
        if not (codes != 32).any():
            continue
        codes = np.r_[np.uint64(32), codes, np.uint64(32)]
        for n in SIZES:
            gram = np.full(len(codes) - n + 1, n, np.uint64)
            for k in range(n):
                gram = gram * np.uint64(0x100000001B3) + codes[k : len(codes) - n + 1 + k]
            place = (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13)
            found[row] += np.bincount(place.astype(np.int64), minlength=BUCKETS)
        found[row] /= found[row].sum()
    return found


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """A row of 0 and 1 for each of ``n`` languages; no column is constant, a repeat or the opposite of another.

    Few languages get the exhaustive code, whose words differ in half of all bits; many get
    the random code with the greatest least distance of a number of draws.
    """
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 6:
        return np.array([(1, *c) for c in itertools.product((0, 1), repeat=n - 1)][:-1], np.int8).T
    chance, best, reach = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = chance.integers(0, 2, (n, int(np.ceil(10 * np.log2(n))))).astype(np.int8)
        code = np.unique(np.where(code[:1] == 1, code, 1 - code), axis=1)
        code = code[:, (code.min(axis=0) == 0)]
        least = min(int((a != b).sum()) for a, b in itertools.combinations(code, 2))
        if least > reach:
            best, reach = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, 0 or 1
    weights: np.ndarray  # n-grams x bits
    border: np.ndarray  # bits
    trust: np.ndarray  # languages x bits, rows sum to 1

    def margins(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each bit's signed distance from the border, and whether the text has a letter."""
        seen = frequencies(texts)
        return np.clip(seen @ self.weights - self.border, -3, 3), seen.any(axis=1)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and lead over the second of each text."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        margin, known = self.margins(texts)
        sign = 2.0 * self.code - 1
        cost = (self.trust[None] * np.exp(-margin[:, None, :] * sign[None])).sum(axis=2)
        if len(self.languages) == 1:
            share = np.ones((len(texts), 1))
        else:
            share = np.exp(-4 * (cost - cost.min(axis=1, keepdims=True)))
            share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        ordered = np.sort(np.c_[share, np.zeros(len(texts))], axis=1)
        names = [self.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist(), strict=True)]
        return names, np.where(known, ordered[:, -1], 0.0), np.where(known, ordered[:, -1] - ordered[:, -2], 0.0)


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", most_per_language: int = 10_000) -> Model:
    """A model from texts with a non-null language.

    About ``most_per_language`` texts of each language are used, chosen by a hash of
    ``key``; the driver gets a vector of fixed length for each language.
    """
    spark = labelled.sparkSession
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = rows.groupBy(F.col(lang).alias("of")).agg(F.count("*").alias("n"))
    part = F.least(F.lit(1.0), F.lit(float(most_per_language)) / F.col("n"))
    draw = F.pmod(F.xxhash64(F.lit(11), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(F.broadcast(counts), F.col(lang) == F.col("of")).filter(draw < part)
    sample = stored(chosen.select(F.col(lang).alias("lang"), F.col(text).alias("text")), "language-sample")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in _small(batches):
            seen = frequencies(batch.column(1).to_pylist())
            names = np.array(batch.column(0).to_pylist(), object)
            for name in set(names):
                total.setdefault(name, np.zeros(BUCKETS))[:] += seen[names == name].sum(axis=0)
        for name, vector in total.items():
            at = np.flatnonzero(vector)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(vector[at])], names=["lang", "at", "sum"])

    added = sample.mapInArrow(leaving_nothing(sums), "lang string, at int, sum double").groupBy("lang", "at").agg(F.sum("sum").alias("sum"))
    vectors = added.groupBy("lang").agg(F.collect_list("at").alias("at"), F.collect_list("sum").alias("sum")).collect()
    found = {r["lang"]: (r["at"], r["sum"]) for r in vectors}
    languages = sorted(found)
    mean = np.zeros((len(languages), BUCKETS))
    for row, name in enumerate(languages):
        mean[row, found[name][0]] = found[name][1]
    mean = mean / mean.sum(axis=1, keepdims=True) if languages else mean
    code = codewords(len(languages))
    floor = 1e-6
    weights, border = np.zeros((BUCKETS, code.shape[1])), np.zeros(code.shape[1])
    for bit in range(code.shape[1]):
        one, zero = mean[code[:, bit] == 1], mean[code[:, bit] == 0]
        weights[:, bit] = np.log((one.mean(axis=0) + floor) / (zero.mean(axis=0) + floor))
        high, low = (one @ weights[:, bit]).min(), (zero @ weights[:, bit]).max()
        scale = max((high - low) / 2, 1e-3)
        border[bit] = (high + low) / 2 / scale
        weights[:, bit] /= scale
    flat = np.full(code.shape, 1.0 / max(code.shape[1], 1))
    model = Model(languages, code, weights.astype(np.float32), border, flat)
    if code.shape[1]:
        model.trust = _trust(spark, sample, model)
    return model


def _small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _trust(spark, sample: DataFrame, model: Model) -> np.ndarray:
    """How often each bit is right on each language; every row sums to 1."""
    shared = spark.sparkContext.broadcast(model)

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        row_of = {name: i for i, name in enumerate(model.languages)}
        hits, n = np.zeros(model.code.shape), np.zeros(len(model.languages))
        for batch in _small(batches):
            margin, known = model.margins(batch.column(1).to_pylist())
            rows = np.array([row_of[x] for x in batch.column(0).to_pylist()])
            np.add.at(hits, rows[known], (margin[known] > 0) == (model.code[rows[known]] == 1))
            np.add.at(n, rows[known], 1)
        lang, bit = np.indices(hits.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang.ravel(), pa.int32()), pa.array(bit.ravel(), pa.int32()), pa.array(hits.ravel()), pa.array(n[lang.ravel()])],
            names=["lang", "bit", "hits", "n"],
        )

    rows = sample.mapInArrow(leaving_nothing(right), "lang int, bit int, hits double, n double").groupBy("lang", "bit").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect()
    trust = np.full(model.code.shape, 1e-3)
    for r in rows:
        trust[r["lang"], r["bit"]] += r["hits"] / r["n"] if r["n"] else 1.0
    return trust / trust.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, model: Model, text: str = "text", least_score: float = 0.5, least_lead: float = 0.1) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous``; columns of these names are replaced, all others stay."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]
    schema = docs.select(*names, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in slices(batches, text, 4 << 20):
            for at in range(0, big.num_rows, 256):
                batch = big.slice(at, 256)
                texts = [x or "" for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                lang, score, lead = shared.value.predict(texts)
                doubt = (score < least_score) | (lead < least_lead)
                columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang), pa.array(score), pa.array(doubt)], names=schema.names)

    return docs.select(*names).mapInArrow(leaving_nothing(run), schema)


def held_out(doc_id: str, folds: int = 5) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0
