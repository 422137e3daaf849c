"""The subword lattice model against sums over every segmentation, one by one."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import nothing, odd, odd_rows, small  # noqa: F401

from sparkwell.llm import sentencepiece_tokens
from sparkwell.llm import subword_lattice as sl
from sparkwell.llm.queries import QUERIES
from sparkwell.llm.queries_text import MODEL_PATH

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RAW = sentencepiece_tokens.model_bytes(MODEL_PATH)
WORDS = ["the", "banana", "élan", "\U0001d538\U0001d539x", "▁x", "a", "été", "thethethe", "x\0y", "ظظظ"]


@pytest.fixture(scope="module")
def pieces():
    return sl.Pieces(RAW)


@pytest.fixture(scope="module")
def places(pieces):
    """{piece text: its place}, from the library's own reading of the file."""
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    usable = [theirs.id_to_piece(i) for i in range(theirs.get_piece_size()) if not (theirs.is_byte(i) or theirs.is_control(i) or theirs.is_unknown(i))]
    return {p: i for i, p in enumerate(p for p in usable if "▁" not in p[1:])}


def segmentations(word, pieces, places):
    """Every way to cut a word with its marker into pieces, as lists of piece places."""
    chars = [("▁", True), *((c, False) for c in word)]

    def cut(at):
        if at == len(chars):
            yield []
        for end in range(at + 1, min(len(chars), at + pieces.longest) + 1):
            text = "".join(c for c, _ in chars[at:end])
            marked = [m for _, m in chars[at:end]]
            plain = all((c == "▁") == m for (c, m) in chars[at:end])
            if plain and text in places and marked[1:] == [False] * (end - at - 1):
                used = [places[text]]
            elif end == at + 1:
                used = [pieces.n - 256 + b for b in text.encode()]
            else:
                continue
            for rest in cut(end):
                yield used + rest

    return list(cut(0))


def by_hand(word, weights, pieces, places):
    return math.fsum(math.exp(sum(weights[i] for i in used)) for used in segmentations(word, pieces, places))


def test_pieces_are_those_of_the_file(pieces, places):
    assert pieces.n == len(places) + 256 and abs(np.exp(pieces.first).sum() - 1) < 1e-9


def test_forward_sums_all_segmentations(pieces, places):
    weights = np.stack([pieces.first, np.log(np.random.default_rng(1).dirichlet(np.ones(pieces.n)))])
    for at, lattice in sl.lattices(pieces, WORDS):
        found = lattice.forward(weights)[:, -1]
        for column, i in enumerate(at.tolist()):
            for k in range(2):
                assert math.exp(found[k, column]) == pytest.approx(by_hand(WORDS[i], weights[k], pieces, places), rel=1e-9)


def test_expected_uses(pieces, places):
    counts = np.arange(1, len(WORDS) + 1, dtype=np.int64)[:, None] * np.array([[7, 0]])
    made = sum(lattice.expected(pieces.first, counts[at]) for at, lattice in sl.lattices(pieces, WORDS))
    wanted = np.zeros(pieces.n)
    for word, n in zip(WORDS, counts[:, 0].tolist(), strict=True):
        whole = by_hand(word, pieces.first, pieces, places)
        for used in segmentations(word, pieces, places):
            np.add.at(wanted, used, n * math.exp(sum(pieces.first[i] for i in used)) / whole)
    assert np.abs(made[0] / sl.UNIT - wanted).max() < 0.01 and not made[1].any()


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain_scores(rows):
    """{row: (id, held out, tokens, known, N, base score)}"""
    name = lambda i: "" if i is None else str(i)
    aside = [zlib.crc32(name(i).encode()) % 7 == 2 for i, *_ in rows]
    learned = Counter(w for (_, t, *_), out in zip(rows, aside, strict=True) if not out for w in tokens(t))
    ends = len(rows) - sum(aside)
    total, distinct = sum(learned.values()) + ends, len(learned) + (ends > 0)
    made = []
    for (i, t, *_), out in zip(rows, aside, strict=True):
        words = tokens(t)
        base = sum(math.log10((learned[w] + 1) / (total + distinct + 1)) for w in words) + math.log10((ends + 1) / (total + distinct + 1))
        made.append((i, out, len(words) + 1, sum(learned[w] > 0 for w in words) + (ends > 0), total, base))
    return made


def same(got, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for a, b in zip(sorted(got, key=key), sorted(wanted, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


COLUMNS = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")


def test_query_on_odd_texts(spark, odd, odd_rows, tmp_path):
    odd.selectExpr("* except (doc_id)", "if(doc_id = 50, null, doc_id) as doc_id").unionByName(odd.filter("doc_id = 3")).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(None if i == 50 else i, t) for i, t, *_ in odd_rows]
    got = QUERIES["op13_subword_lattice"](spark, str(tmp_path)).collect()
    same([tuple(r[c] for c in COLUMNS) for r in got], plain_scores([*rows, rows[3]]))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_scores_are_marginals_over_classes_and_segmentations(spark, small, pieces, places):
    rows = [(i, t[:300], lang) for i, t, lang, _ in small[:60]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names = sl.class_names(docs, "doc_id", "lang", 2)
    counts = sl.stored(sl.word_counts(docs, "doc_id", "text", "lang", names), "test-counts")
    model = sl.train(docs, counts, names, RAW, "doc_id", "lang", rounds=1)
    learned = [(i, tokens(t), lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    own = [learned, *([r for r in learned if r[2] == n] for n in names)]
    found = [Counter(w for _, ws, _ in part for w in ws) for part in own]
    prior = [len(learned) - sum(map(len, own[1:])) + 1, *(len(p) + 1 for p in own[1:])]
    prior = [p / (len(learned) + len(names) + 1) for p in prior]
    memo = {}

    def log_p(word, k):
        if (word, k) not in memo:
            spelled = by_hand(word, model.weights[k], pieces, places)
            rest = (sl.DISCOUNT * len(found[k]) + 1) * spelled
            memo[word, k] = math.log((max(found[k][word] - sl.DISCOUNT, 0) + rest) / (sum(found[k].values()) + len(own[k]) + 2))
        return memo[word, k]

    wanted = {}
    for i, t, _ in rows[:25]:
        by_class = []
        for k in range(len(names) + 1):
            end = (len(own[k]) + 1) / (sum(found[k].values()) + len(own[k]) + 2)
            by_class.append(math.log(prior[k]) + math.log(end) + sum(log_p(w, k) for w in tokens(t)))
        top = max(by_class)
        wanted[i] = (top + math.log(sum(math.exp(x - top) for x in by_class))) / math.log(10)
    scored = sl.stored(sl.scored_words(counts, model), "test-words")
    for sent in (0, 30, 400_000):
        got = {r.doc_id: r.score for r in sl.score(docs, scored, model, broadcast_words=sent).collect()}
        assert all(got[i] == pytest.approx(s, rel=1e-9) for i, s in wanted.items())


def test_training_helps(spark, sf_dir):
    """Held-out texts gain from re-estimated weights and from classes; texts that were learned from beat the base."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    total = lambda df, kept: df.filter(kept).selectExpr("sum(score) as s", "sum(base_score) as b").first()
    full = QUERIES["op13_subword_lattice"](spark, sf_dir)
    assert total(full, "not held_out").s > total(full, "not held_out").b
    plain = total(sl.log_probabilities(docs, RAW, class_col=None, rounds=0), "held_out").s
    assert total(full, "held_out").s > total(sl.log_probabilities(docs, RAW, class_col=None), "held_out").s > plain


def test_no_more_than_one_in_all(pieces):
    """Weights of one class bring words, and the end, to at most 1: what words get in the model adds up."""
    model = sl.Scorer(RAW, [], pieces.first[None], np.zeros(1), np.array([30.0]), np.array([5.0]), np.array([4.0]), 5)
    counts = np.array([[10], [8], [6], [1]])
    p = np.exp(model.words(pieces, ["the", "of", "xq", "zebra"], counts))
    assert p.sum() + np.exp(model.end())[0] < 1


def test_nothing_and_no_training(spark, nothing):
    assert sl.log_probabilities(nothing, RAW).collect() == []
    aside = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    docs = spark.createDataFrame([(i, t, "en") for i, t in zip(aside, ("a b a", None, "w" * 20_000), strict=True)], "doc_id long, text string, lang string")
    got = sl.log_probabilities(docs, RAW).collect()
    same([tuple(r[c] for c in COLUMNS) for r in got], plain_scores([(r.doc_id, r.text) for r in docs.collect()]))
    assert all(math.isfinite(r.score) for r in got)


def test_windows_are_looked_up_once_for_all_classes(pieces, monkeypatch):
    counts = np.array([[3 + i, i % 3, 2 * (i % 2)] for i in range(len(WORDS))], np.int64)
    weights = np.stack([pieces.first, *np.log(np.random.default_rng(2).dirichlet(np.ones(pieces.n), 2))])
    wanted = [sum(lattice.expected(weights[k], counts[at][:, [k]])[0] for at, lattice in sl.lattices(pieces, WORDS)) for k in range(3)]
    looked, whole = [], sl.Pieces.edges
    monkeypatch.setattr(sl.Pieces, "edges", lambda self, codes: looked.append(len(codes)) or whole(self, codes))
    assert (sl.expected_uses(pieces, WORDS, counts, weights) == np.stack(wanted)).all()
    assert sum(looked) == len(WORDS)
    looked.clear()
    assert (sl.expected_uses(pieces, WORDS, counts, weights[[0, 0, 0]]) > 0).any(axis=1).all() and sum(looked) == len(WORDS)


def test_the_sieve_keeps_every_window_that_is_a_piece(pieces):
    chance = np.random.default_rng(3)
    words = ["".join(chance.choice(list("etaoins\u00e9\u0638"), 12)) for _ in range(300)]
    for _, lattice in sl.lattices(pieces, words):
        hashed = np.zeros(lattice.codes.shape, np.uint64)
        width = lattice.codes.shape[1]
        for size in range(lattice.edges.shape[1]):
            hashed = hashed[:, : width - size] * sl.MULTIPLIER + lattice.codes[:, size:].astype(np.uint64) + np.uint64(1)
            known, piece = pieces.table[size][:2]
            there = np.isin(hashed, known)
            assert ((lattice.edges[size:, size].T >= 0) == there).all()
            assert (lattice.edges[size:, size].T[there] == piece[np.searchsorted(known, hashed[there])]).all()
