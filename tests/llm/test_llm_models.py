"""Language ID, mixing, SentencePiece and the quality classifier."""

import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import nothing, odd, odd_rows, small  # noqa: F401
from pyspark.sql import functions as F

from sparkwell.llm import language_id, mixing, weak_quality
from sparkwell.llm import sentencepiece_tokens as sp
from sparkwell.llm.queries_text import MODEL_PATH

KEPT = {"kept", "score", "id", "class", "runs", "size", "text_key"}


# Language ID


def test_codewords_correct_errors():
    for n in (2, 3, 4, 6, 9, 40):
        code = language_id.codewords(n)
        assert len({tuple(c) for c in code.T}) == code.shape[1]
        assert all(0 < c.sum() < n for c in code.T)
        least = min(int((a != b).sum()) for i, a in enumerate(code) for b in code[:i])
        assert least >= (1 if n < 4 else code.shape[1] // 4)
    assert language_id.codewords(1).shape == (1, 0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    aside = language_id.held_out("doc_id")
    model = language_id.train(docs.filter(~aside))
    found = language_id.predict(docs.filter(aside), model)
    right, low, high = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert right > 0.98 and 0 <= low <= high <= 1


def test_training_is_blind_to_the_held_out_fold(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = docs.filter(~language_id.held_out("doc_id"))
    other = docs.filter(language_id.held_out("doc_id")).withColumn("lang", F.lit("xx"))
    one, two = language_id.train(learned), language_id.train(learned.union(other).filter(~language_id.held_out("doc_id")))
    assert one.languages == two.languages and np.allclose(one.weights, two.weights, atol=1e-5)


def test_odd_texts_and_languages(spark, odd, nothing):
    model = language_id.train(odd)
    found = {r.doc_id: r for r in language_id.predict(odd, model).collect()}
    for row in found.values():
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not letters) and (row.score == 0) == (not letters)
    assert KEPT - {"score"} <= set(found[0].asDict())
    assert language_id.predict(nothing, model).collect() == []
    blank = language_id.train(nothing)
    assert {r.lang_pred for r in language_id.predict(odd, blank).collect()} == {"und"}
    single = language_id.train(odd.filter("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in language_id.predict(odd, single).collect()} == {("en", 1.0), ("und", 0.0)}


def test_decoding_agrees_with_a_plain_restatement(spark, odd, small):
    texts = [t for _, t, _, _ in small[:60]] + [r.text for r in odd.select("text").collect()]
    labelled = spark.createDataFrame([(i, t, lang) for i, t, lang, _ in small[:400]], "doc_id long, text string, lang string")
    model = language_id.train(labelled)
    rows = language_id.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        seen = language_id.frequencies([text])[0].astype(float)
        losses = []
        for word, trust in zip(model.code, model.trust, strict=True):
            loss = 0.0
            for bit in range(model.code.shape[1]):
                margin = sum(seen[g] * model.weights[g, bit] for g in np.flatnonzero(seen)) - model.border[bit]
                loss += trust[bit] * np.exp(-max(-3.0, min(3.0, margin)) * (1 if word[bit] else -1))
            losses.append(loss)
        order = np.argsort(losses)
        if losses[order[1]] - losses[order[0]] > 1e-4:
            assert row.lang_pred == model.languages[order[0]]


# Mixing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 4)), min_size=1, max_size=8, unique_by=lambda x: x[0]), st.integers(0, 400), st.integers(1, 200))
def test_fit_is_the_best_subset_sum(lengths, budget, capacity):
    size, count = (np.array(x) for x in zip(*lengths, strict=True))
    total = int((size * count).sum())
    taken = mixing.fit(size, count, budget, capacity)
    assert ((taken >= 0) & (taken <= count)).all()
    reached = int((size * taken).sum())
    assert reached <= budget
    sums = {0}
    for n, c in lengths:
        sums = {s + n * k for s in sums for k in range(c + 1)}
    if budget >= total or budget <= capacity:
        assert reached == max(s for s in sums if s <= budget)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(60_000, 300_000), min_size=1, max_size=12), st.floats(0.05, 0.95), st.sampled_from([1, 1000]))
def test_fit_exchanges_long_documents(lengths, share, step):
    size, count = np.unique(np.array(lengths) // step * step, return_counts=True)
    sums = np.array([0])
    for n in np.repeat(size, count):
        sums = np.unique(np.r_[sums, sums + n])
    budget = int(share * sums[-1])
    taken = mixing.fit(size, count, budget)
    assert ((taken >= 0) & (taken <= count)).all()
    assert int((size * taken).sum()) == sums[sums <= budget].max()


def test_fit_of_many_lengths_misses_nothing():
    assert mixing.fit(np.array([60_000, 40_000, 90_000]), np.ones(3, int), 100_000).tolist() == [1, 1, 0]
    size = np.r_[1, np.arange(2, 4000, 2)]
    count = np.r_[1, np.arange(1999) % 300 + 1]
    half = int((size * count).sum()) // 2
    for budget in (half, half + 1):
        assert int((size * mixing.fit(size, count, budget)).sum()) == budget


def test_quotas_of_a_very_frequent_length(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    docs = spark.createDataFrame([(i, "three words here", "a") for i in range(900)], "doc_id long, text string, source string")
    made = mixing.decide(docs, {"a": 1}, share=0.5).collect()
    assert sum(r.copies for r in made) == 450 and {r.copies for r in made} == {0, 1}


def test_targets_share_the_excess():
    found = mixing.targets({"a": 10, "b": 100, "c": 100, None: 0}, {"a": 3, "b": 1, "c": 2, None: 3}, 1.5, 2)
    assert found["a"] == 20 and found[None] == 0
    assert abs(found["b"] - 295 / 3) < 1e-9 and abs(found["c"] - 590 / 3) < 1e-9
    assert mixing.cyclic_weights(["b", None, "a", "c", "é"], (3, 1, 2)) == {"a": 3, "b": 1, "c": 2, "é": 3, None: 1}


def check_mix(rows):
    by_source = {}
    for r in rows:
        assert r.taken in (0, r["size"], 2 * r["size"])
        by_source.setdefault(r.source, []).append(r)
    names = sorted(s for s in by_source if s is not None) + [None] * (None in by_source)
    total = {s: sum(r["size"] for r in by_source[s]) for s in names}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    wanted = mixing.targets(total, weight, 1.5, 2)
    for s in names:
        got = by_source[s]
        assert {r.source_size for r in got} == {total[s]}
        assert all(abs(r.target - wanted[s]) < 1e-6 for r in got)
        assert wanted[s] <= 2 * total[s] + 1e-6
        full = min(int(wanted[s] // total[s]), 2) if total[s] else 0
        rest, sums = int(wanted[s] - full * total[s] + 0.5), 1
        for r in got if full < 2 else []:
            sums |= sums << r["size"] & ((1 << rest + 1) - 1)
        assert sum(r.taken for r in got) == full * total[s] + sums.bit_length() - 1


def test_mix_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.decide(docs, (3, 1, 2)).collect()
    check_mix(rows)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.decide(docs.repartition(5), (3, 1, 2)).collect()), key=repr)


def test_mix_of_odd_rows(odd, odd_rows, nothing):
    rows = mixing.decide(odd, (3, 1, 2)).collect()
    assert len(rows) == len(odd_rows)
    check_mix(rows)
    taken = {r.doc_id: r.copies for r in rows}
    mixed = mixing.mixed(odd, (3, 1, 2))
    assert mixed.columns == odd.columns
    found = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert found == {i: n for i, n in taken.items() if n}
    assert mixing.decide(nothing, (3, 1, 2)).collect() == [] and mixing.mixed(nothing, (3, 1, 2)).collect() == []


def test_hot_length_and_repeated_rows(spark):
    rows = [(i % 700, "five words in all here", "a") for i in range(2000)] + [(9000 + i, "w " * (i + 1), "b") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    made = mixing.decide(docs, {"a": 1, "b": 1}, share=0.5).collect()
    assert sum(r.taken for r in made if r.source == "a") == 3085 and {r.target for r in made if r.source == "a"} == {3087.5}
    total = sum(r.copies for r in made)
    assert mixing.mixed(docs, {"a": 1, "b": 1}, share=0.5).count() == total


# SentencePiece


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def unigram_model(byte_fallback=True, prefix=True, squeeze=False):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = ["▁the", "▁ta", "ble", "▁t", "a", "b", "l", "e", "▁", "t", "h", "he", "▁a", "ab", "\n"]
    pieces += [(w, -2.0 - 0.37 * k, 1) for k, w in enumerate(words)]
    body = b"".join(message((1, message((1, p), (2, s), (3, kind)))) for p, s, kind in pieces)
    trainer = message((3, 1), (35, int(byte_fallback)), (40, 0), (41, 1), (42, 2), (43, (1 << 64) - 1))
    normal = message((1, "identity"), (3, int(prefix)), (4, int(squeeze)), (5, 1))
    return body + message((2, trainer), (3, normal))


ODD_TEXTS = ["the table", "", " ", "  a  ", "a ble the", "ta  ble\nthe", "é\U0001d538 the", "▁the table", "tttt", "ab " * 50]


@pytest.mark.parametrize("options", [{}, {"byte_fallback": False}, {"squeeze": True}, {"prefix": False}], ids=str)
def test_unigram_models_agree_with_the_library(options):
    import sentencepiece

    raw = unigram_model(**options)
    made, theirs = sp.Encoder(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
    assert made.model.kind == sp.UNIGRAM
    flat, bounds, _, _ = made.encode(ODD_TEXTS)
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == theirs.encode(ODD_TEXTS)


def test_bpe_model_agrees_with_the_library(spark, odd, odd_rows, small):
    import sentencepiece

    raw = sp.model_bytes(MODEL_PATH)
    theirs = sentencepiece.SentencePieceProcessor(model_proto=raw)
    found = sp.encode(odd, raw)
    assert KEPT <= set(found.columns) and "text" not in found.columns
    rows = {r.doc_id: r for r in found.collect()}
    for i, text, _, _ in odd_rows:
        if text is None:
            assert rows[i].ids is None and rows[i].n_tokens is None and rows[i].ids_sha256 is None
        else:
            assert rows[i].ids == theirs.encode(text) and rows[i].n_tokens == len(rows[i].ids)
            assert rows[i].parity and rows[i].round_trip
    back = {r.doc_id: r.text for r in sp.decode(found, raw).collect()}
    assert back == {r[0]: r[1] for r in odd_rows}


@pytest.mark.parametrize("options", [{}, {"squeeze": True}, {"prefix": False, "squeeze": True}], ids=str)
def test_parity_is_that_of_whole_texts(options):
    """Where the rebuilt normaliser and the library part ways, as for a tab at the edge of a squeezed text, parity says so."""
    import sentencepiece

    raw = unigram_model(**options)
    theirs = sentencepiece.SentencePieceProcessor(model_proto=raw)
    texts = [*ODD_TEXTS, "\tab", "ab\t", " \t a  b ", "\n"]
    flat, bounds, same, back = sp.Encoder(raw).encode(texts)
    found = [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    assert same.tolist() == [a == b for a, b in zip(found, theirs.encode(texts), strict=True)] and same.any()


def test_two_threads_give_the_ids_of_one(odd):
    raw = sp.model_bytes(MODEL_PATH)
    one, two = ({r.doc_id: r.ids for r in sp.encode(odd, raw, threads=n).collect()} for n in (1, 2))
    assert one == two


def test_encoder_starts_anew_when_full():
    raw = sp.model_bytes(MODEL_PATH)
    small_one, large = sp.Encoder(raw, most_words=3), sp.Encoder(raw)
    for text in ("one two three four", "five six", "one seven", "", "one two three four"):
        a, b = small_one.encode([text, text]), large.encode([text, text])
        assert all((x == y).all() for x, y in zip(a, b, strict=True))


def test_no_rows_to_encode(nothing):
    raw = sp.model_bytes(MODEL_PATH)
    assert sp.encode(nothing, raw).collect() == []
    assert sp.decode(sp.encode(nothing, raw), raw).collect() == []


def test_odd_models_are_refused():
    with pytest.raises(ValueError):
        sp.Model.read(message((2, message((3, 3)))))


# Quality


def test_label_model_finds_the_accuracies():
    chance = np.random.default_rng(6)
    n, k = 20_000, len(weak_quality.LABELLERS)
    truth = chance.random(n) < 0.8
    right = np.linspace(0.75, 0.97, k)
    votes = np.where(chance.random((n, k)) < right, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    votes[chance.random((n, k)) < 0.3] = 0
    patterns, counts = np.unique([weak_quality.pattern(v) for v in votes.tolist()], return_counts=True)
    model = weak_quality.fit_labels(patterns, counts)
    assert abs(model.good - 0.8) < 0.03
    assert np.abs(np.array(list(model.accuracy().values())) - right).max() < 0.05


def test_label_model_agrees_with_a_plain_restatement():
    chance = np.random.default_rng(9)
    k = len(weak_quality.LABELLERS)
    rows = [[int(v) for v in chance.choice([-1, 0, 1], k, p=[0.2, 0.3, 0.5])] for _ in range(60)]
    patterns, counts = np.unique([weak_quality.pattern(v) for v in rows], return_counts=True)
    model = weak_quality.fit_labels(patterns, counts, rounds=25)
    by_pattern = {weak_quality.pattern(v): v for v in rows}
    # The same row by row: every document has its own belief, no counts of patterns.
    belief = []
    for votes in rows:
        against = votes.count(-1)
        belief.append(0.1 if against >= 2 else 0.9 if against == 0 else 0.5)
    for _ in range(25):
        good = min(max(sum(belief) / len(rows), 0.01), 0.99)
        says = {}
        for label in range(k):
            for kind in (0, 1):
                mass = {v: 1.0 + sum((b if kind else 1 - b) for b, votes in zip(belief, rows, strict=True) if votes[label] == v) for v in (-1, 1)}
                says[label, kind] = {-1: mass[-1] / sum(mass.values()), 0: 1.0, 1: mass[1] / sum(mass.values())}
        belief = []
        for votes in rows:
            one, other = good, 1 - good
            for label, v in enumerate(votes):
                one, other = one * says[label, 1][v], other * says[label, 0][v]
            belief.append(one / (one + other))
    found = dict(zip(patterns.tolist(), model.posterior(patterns).tolist(), strict=True))
    for votes, b in zip(rows, belief, strict=True):
        assert abs(found[weak_quality.pattern(votes)] - b) < 1e-6
    assert len(by_pattern) == len(patterns)


def test_quality_without_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model, scorer = weak_quality.train(docs)
    found = weak_quality.score(docs, model, scorer).join(labels, "doc_id")
    good, bad = (found.filter(f"quality = {q}").agg(F.avg(F.col("kept").cast("double"))).first()[0] for q in (1, 0))
    assert good > 0.97 and bad < 0.15


def test_quality_of_odd_texts(odd, odd_rows, nothing):
    model, scorer = weak_quality.train(odd)
    found = {r.doc_id: r for r in weak_quality.score(odd, model, scorer).collect()}
    assert KEPT - {"kept", "score"} <= set(found[0].asDict())
    for i, text, _, _ in odd_rows:
        assert 0 <= found[i].score <= 1 and 0 <= found[i].posterior <= 1
        if not (text or "").strip():
            assert found[i].score == 0 and not found[i].kept
    assert weak_quality.score(nothing, model, scorer).collect() == []
    none, silent = weak_quality.train(nothing)
    assert {r.score for r in weak_quality.score(odd, none, silent).collect()} <= {0.0} or not any(r.kept for r in weak_quality.score(odd, none, silent).collect())
