"""A quality classifier without labels: heuristic labellers, their accuracies by expectation-maximisation, and a hashed linear scorer.

Each labeller looks at a whole text and says good, bad or nothing. The label model takes the
answers as independent given the unknown class and estimates, from the counts of all answer
patterns in the corpus, how often each labeller gives each answer for good and for bad texts. The
posterior of a text's pattern then serves as a soft label to fit a logistic scorer over hashed features, which
also judges texts on which the labellers are silent.

Patterns are at most 3 to the power of the number of labellers, so their counts fit the
driver at any size of the corpus. The scorer is fitted on a bounded sample (``most_rows``).

Defined results: a null or empty text, or one of white space alone, has score 0 and is not kept; every row is scored by its
text alone, whole; without any text the scorer scores everything 0.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.shared import slices, stored

GOOD, SILENT, BAD = 1, 0, -1
BUCKETS = 1 << 12

#: Classes of characters.
SPACE, SMALL, LARGE, DIGIT, POINT, SIGN = range(6)
POINTS = ".,;:'\"()-?"


def _class_table() -> np.ndarray:
    table = np.full(1 << 16, SIGN, np.uint8)
    for code in range(1 << 16):
        char = chr(code)
        if char.isspace():
            table[code] = SPACE
        elif char.isalpha():
            table[code] = LARGE if char.isupper() else SMALL
        elif char.isdigit():
            table[code] = DIGIT
        elif char in POINTS:
            table[code] = POINT
    return table


_table: list[np.ndarray] = []


def _classes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The code points, and the class of each; those beyond the basic plane count as small letters or signs."""
    if not _table:
        _table.append(_class_table())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _table[0][np.minimum(codes, 0xFFFF)]
    for at in np.flatnonzero(codes > 0xFFFF).tolist():
        kinds[at] = SMALL if chr(int(codes[at])).isalpha() else SIGN
    return codes, kinds


@dataclass
class Facts:
    """What the labellers look at."""

    words: int
    signs: float
    capitals: float
    commonest: float
    doubled: float
    bare_signs: float
    word_length: float
    closed_lines: float
    shouting: float
    marked: float
    packed: float


def _packed(text: str) -> float:
    """What a compressor leaves of the text."""
    raw = text.encode("utf-8", "surrogatepass")
    return len(zlib.compress(raw, 1)) / max(len(raw), 1)


def facts(text: str) -> Facts:
    words = text.split()
    n = max(len(words), 1)
    _, kinds = _classes(text)
    count = np.bincount(kinds, minlength=6)
    seen, letters = max(int(count[1:].sum()), 1), max(int(count[SMALL] + count[LARGE]), 1)
    lines = [x for x in (line.strip() for line in text.split("\n")) if x]
    return Facts(
        words=len(words),
        signs=int(count[SIGN]) / seen,
        capitals=int(count[LARGE]) / letters,
        commonest=max(Counter(words).values(), default=0) / n,
        doubled=sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        bare_signs=sum(not any(c.isalnum() for c in w) for w in words if len(w) < 4) / n,
        word_length=seen / n,
        closed_lines=sum(x[-1] in ".!?\"'" for x in lines) / max(len(lines), 1),
        shouting=text.count("!") / n,
        marked=sum(not (w[-1].isalnum() or w[-1] in POINTS) for w in words) / n,
        packed=_packed(text),
    )


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else SILENT


#: Each labeller's name and rule; the rules overlap on purpose.
LABELLERS = {
    "signs": lambda f: _vote(f.signs > 0.08, f.signs < 0.02),
    "capitals": lambda f: _vote(f.capitals > 0.4, 0 < f.capitals < 0.1),
    "commonest": lambda f: _vote(f.words >= 20 and f.commonest > 0.3, f.words >= 20 and f.commonest < 0.12),
    "doubled": lambda f: _vote(f.words >= 10 and f.doubled > 0.2, f.words >= 10 and f.doubled < 0.03),
    "marked_words": lambda f: _vote(f.marked > 0.2, f.marked < 0.02),
    "packed": lambda f: _vote(f.words >= 40 and f.packed < 0.15, f.words >= 40 and f.packed > 0.3),
    "bare_signs": lambda f: _vote(f.bare_signs > 0.2, f.bare_signs < 0.02),
    "word_length": lambda f: _vote(f.word_length > 14 or f.word_length < 2, 3.5 <= f.word_length <= 9),
    "closed_lines": lambda f: _vote(f.closed_lines < 0.1, f.closed_lines > 0.7),
    "shouting": lambda f: _vote(f.shouting > 0.3, f.shouting < 0.1),
}


def answers(text: str) -> list[int]:
    seen = facts(text)
    return [rule(seen) for rule in LABELLERS.values()]


def pattern(votes: list[int]) -> int:
    """All answers as one number in base 3."""
    return sum((v + 1) * 3**k for k, v in enumerate(votes))


def votes_of(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS))[None] % 3


@dataclass
class LabelModel:
    """The share of good texts, and for each class and labeller how its answers divide when it speaks; silence says nothing."""

    good: float
    answer: np.ndarray  # class (bad, good) x labeller x answer (bad, silent, good); 1 for silent

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        votes = votes_of(patterns)
        at = np.arange(len(LABELLERS))
        score = np.stack([np.log(self.answer[c][at, votes]).sum(axis=1) + np.log([1 - self.good, self.good][c]) for c in (0, 1)])
        return 1 / (1 + np.exp(np.clip(score[0] - score[1], -700, 700)))

    def accuracy(self) -> dict[str, float]:
        """How often each labeller is right when it speaks."""
        weight = np.array([1 - self.good, self.good])
        right = weight[0] * self.answer[0][:, 0] + weight[1] * self.answer[1][:, 2]
        spoken = right + weight[0] * self.answer[0][:, 2] + weight[1] * self.answer[1][:, 0]
        return dict(zip(LABELLERS, (right / spoken).tolist(), strict=True))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 1.0) -> LabelModel:
    """Expectation-maximisation; at the start two labellers that agree on bad are believed, as faults rarely come together."""
    votes, n = votes_of(patterns), counts.astype(float)
    against = (votes == 0).sum(axis=1)
    belief = np.where(against >= 2, 0.1, np.where(against == 0, 0.9, 0.5))
    model = None
    for _ in range(rounds):
        answer = np.ones((2, len(LABELLERS), 3))
        for c, share in enumerate((1 - belief, belief)):
            said = np.stack([(share * n) @ (votes == v) + smooth for v in (0, 2)], axis=1)
            answer[c][:, [0, 2]] = said / said.sum(axis=1, keepdims=True)
        good = float(np.clip((belief * n).sum() / max(n.sum(), 1), 0.01, 0.99))
        model = LabelModel(good, answer)
        new = model.posterior(patterns)
        if np.abs(new - belief).max(initial=0) < 1e-9:
            break
        belief = new
    return model


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their weights: runs of three character classes and signs, and how much the text repeats itself."""
    codes, kinds = _classes(text)
    if not (kinds != SPACE).any():
        return np.zeros(0, np.int64), np.zeros(0)
    # Letters stand for their class, so that the scorer learns form and not vocabulary.
    shape = np.where(kinds == SIGN, codes + 16, np.where(kinds == POINT, codes + 16, kinds)).astype(np.uint64)
    shape = np.r_[np.uint64(SPACE), shape, np.uint64(SPACE)]
    if len(shape) < 3:
        shape = np.pad(shape, (0, 3 - len(shape)))
    gram = ((shape[:-2] * np.uint64(0x100000001B3) + shape[1:-1]) * np.uint64(0x100000001B3) + shape[2:]) * np.uint64(0x9E3779B97F4A7C15)
    count = np.bincount((gram >> np.uint64(64 - 12)).astype(np.int64), minlength=BUCKETS).astype(float) / len(gram)
    words = text.split()
    n = len(words)
    extra = {1: 4 * sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, 2: max(Counter(words).values()) / n if n >= 20 else 0.0}
    extra[3] = 4 * max(0.0, 0.3 - _packed(text)) if n >= 40 else 0.0
    for k, v in extra.items():
        count[k] += v
    at = np.flatnonzero(count)
    return at, np.sqrt(count[at])


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        at, value = features(text)
        if not len(at):
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ value + self.bias, -50, 50))))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 300, rate: float = 0.5, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels, full gradient with momentum."""
    if not rows:
        return Scorer(np.zeros(BUCKETS), -50.0)
    at = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    label = np.array([r[2] for r in rows])
    # Both classes weigh the same, else a rare one is passed over.
    weigh = np.where(label > 0.5, 0.5 / max((label > 0.5).mean(), 1e-3), 0.5 / max((label <= 0.5).mean(), 1e-3))
    weights, bias, speed, push = np.zeros(BUCKETS), 0.0, np.zeros(BUCKETS), 0.0
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights[at] * value, len(rows)) + bias, -50, 50)))
        error = (guess - label) * weigh / len(rows)
        speed = 0.9 * speed - rate * 10 * (np.bincount(at, error[row] * value, BUCKETS) + decay * weights)
        push = 0.9 * push - rate * error.sum()
        weights, bias = weights + speed, bias + push
    return Scorer(weights, float(bias))


def _texts(batch: pa.RecordBatch, name: str) -> list[str]:
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def patterns_of(docs: DataFrame, text: str) -> DataFrame:
    """(pattern) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 4 << 20):
            yield pa.RecordBatch.from_arrays([pa.array([pattern(answers(t)) for t in _texts(batch, text)], pa.int32())], names=["pattern"])

    return docs.select(text).mapInArrow(run, "pattern int")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", most_rows: int = 8_000) -> tuple[LabelModel, Scorer]:
    """The label model from all texts, and a scorer from about ``most_rows`` of them, chosen by a hash of ``key``."""
    some = docs.filter(F.col(text).isNotNull())
    found = patterns_of(some, text).groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    patterns, counts = np.array([r["pattern"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64)
    model = fit_labels(patterns, counts)
    part = min(1.0, most_rows / max(int(counts.sum()), 1))
    draw = F.pmod(F.xxhash64(F.lit(23), key), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 4 << 20):
            texts = _texts(batch, text)
            each = [features(t) for t in texts]
            columns = [pa.array([pattern(answers(t)) for t in texts], pa.int32())]
            columns += [pa.array([a.tolist() for a, _ in each], pa.list_(pa.int32())), pa.array([v.tolist() for _, v in each], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["pattern", "at", "value"])

    sample = some.filter(draw < part).select(text).mapInArrow(run, "pattern int, at array<int>, value array<double>")
    rows = stored(sample, "quality-sample").collect()
    labels = model.posterior(np.array([r["pattern"] for r in rows], np.int64)) if rows else np.zeros(0)
    used = [(np.array(r["at"], np.int64), np.array(r["value"]), float(p)) for r, p in zip(rows, labels, strict=True) if r["at"]]
    return model, fit_scorer(used)


def score(docs: DataFrame, model: LabelModel, scorer: Scorer, text: str = "text", least: float = 0.35) -> DataFrame:
    """``docs`` with ``posterior`` (of the labellers), ``score`` and ``kept``; columns of these names are replaced, all others stay."""
    names = [c for c in docs.columns if c not in ("posterior", "score", "kept")]
    schema = docs.select(*names, F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score"), F.lit(False).alias("kept")).schema
    shared = docs.sparkSession.sparkContext.broadcast((model, scorer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, scorer = shared.value
        for batch in slices(batches, text, 4 << 20):
            texts = _texts(batch, text)
            belief = model.posterior(np.array([pattern(answers(t)) for t in texts], np.int64))
            found = np.array([scorer.score(t) for t in texts])
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(belief), pa.array(found), pa.array(found >= least)], names=schema.names)

    return docs.select(*names).mapInArrow(run, schema)
