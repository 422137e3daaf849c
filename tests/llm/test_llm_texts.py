"""Suffix dedup, line dedup, MinHash and sentence spans against brute force."""

import llm_brute as brute
import numpy as np
import pytest
from llm_cases import nothing, odd, odd_rows, small  # noqa: F401
from pyspark.sql import functions as F

from sparkwell.llm import line_dedup, minhash, sentence_spans, suffix_dedup
from sparkwell.llm.shared import components

MORE = {"kept", "score", "id", "class", "runs", "size", "text_key"}


def by_id(df, *columns):
    rows = df.select("doc_id", *columns).collect()
    return {r[0]: tuple(r)[1:] for r in rows}


def test_cuts_look_after_every_window_once():
    chance = np.random.default_rng(0)
    for _ in range(10):
        texts = [bytes(chance.integers(97, 97 + chance.integers(1, 6), chance.integers(0, 2000)).astype(np.uint8)) for _ in range(5)]
        texts += [b"a" * 900, b"abc" * 300, b"", b"x" * 399, b"y" * 400]
        raw, starts, ends = suffix_dedup._joined(texts)
        cut, low, high = suffix_dedup.cuts(raw, starts, ends, 400)
        times = np.zeros(len(raw), int)
        for c, a, b in zip(cut, low, high, strict=True):
            assert a <= b <= c < a + suffix_dedup.REACH
            times[a : b + 1] += 1
        wanted = np.zeros(len(raw), int)
        for a, b in zip(starts, ends, strict=True):
            wanted[a : max(a, b - 399)] = 1
        assert (times == wanted).all()


def test_equal_windows_have_equal_cuts():
    chance = np.random.default_rng(1)
    shared = bytes(chance.integers(97, 101, 700).astype(np.uint8))
    places = []
    for _ in range(2):
        text = bytes(chance.integers(97, 101, 500).astype(np.uint8)) + shared + bytes(chance.integers(97, 101, 500).astype(np.uint8))
        cut, low, high = suffix_dedup.cuts(text, np.array([0]), np.array([len(text)]), 400)
        places.append({i - 500: c - i for c, a, b in zip(cut, low, high, strict=True) for i in range(a, b + 1) if 500 <= i <= 800})
    assert places[0] == places[1]


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"group": 1}], ids=["sent", "shuffled", "crowded"])
def test_suffix_dedup(odd, odd_rows, options):
    wanted = brute.repeated_bytes([r[1] for r in odd_rows], 300)
    found = suffix_dedup.dedup(odd, 300, **options)
    assert set(odd.columns) <= set(found.columns)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in found.collect()}
    assert got == {r[0]: w for r, w in zip(odd_rows, wanted, strict=True)}
    assert any(w[1] for w in wanted)


def test_suffix_dedup_of_repeated_rows(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(500))
    rows = spark.createDataFrame([(1, text), (1, text), (2, text[:300]), (None, "x" + text[:450])], "doc_id long, text string")
    got = sorted((r.n_removed for r in suffix_dedup.dedup(rows, 400).collect()), reverse=True)
    assert got == [500, 500, 450, 0]


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}], ids=["sent", "shuffled"])
def test_line_dedup(odd, odd_rows, options):
    wanted = brute.common_lines([r[1] for r in odd_rows], 10)
    found = line_dedup.dedup(odd, 10, **options)
    assert MORE <= set(found.columns)
    assert by_id(found, "n_lines", "n_dropped", "kept") == {r[0]: w for r, w in zip(odd_rows, wanted, strict=True)}
    assert any(w[1] for w in wanted)


def test_many_shards_give_the_same_lines(odd):
    one, many = (line_dedup.dedup(odd, 2, keys_per_shard=n) for n in (10**6, 3))
    assert by_id(one, "kept") == by_id(many, "kept")


def test_lines_come_in_and_go_out(odd):
    counts = line_dedup.line_counts(odd)
    first, second = odd.filter("doc_id % 2 = 0"), odd.filter("doc_id % 2 = 1")
    apart = line_dedup.line_counts(first)
    assert sorted(map(tuple, line_dedup.inserted(apart, second).collect())) == sorted(map(tuple, counts.collect()))
    assert sorted(map(tuple, line_dedup.deleted(counts, second).collect())) == sorted(map(tuple, apart.collect()))
    assert line_dedup.deleted(counts, odd).count() == 0


def test_filters_follow_the_counts(odd):
    before, after = line_dedup.line_counts(odd.filter("doc_id < 50")), line_dedup.line_counts(odd)
    filters = line_dedup.filters_of(before, 2, 3)
    changed = line_dedup.updated_filters(filters, before, after, 2, 3).collect()
    wanted = [bytes(r.key) for r in after.filter("n_docs >= 2").collect()]
    held = {r.shard: line_dedup.CuckooFilter.from_bytes(bytes(r.filter)) for r in changed}
    assert sum(r.n_keys for r in changed) == len(wanted)
    for key in wanted:
        assert held[line_dedup._shard_of(key, 3)].contains(line_dedup.head_of([key]))[0]


def test_cuckoo_filter_takes_and_gives_back():
    chance = np.random.default_rng(4)
    hashes = np.unique(chance.integers(0, 2**63, 20_000).astype(np.uint64))
    held = line_dedup.CuckooFilter.of(hashes)
    assert held.contains(hashes).all()
    assert held.contains(chance.integers(2**63, 2**64, 20_000, dtype=np.uint64)).mean() < 0.001
    held.delete(hashes[:15_000])
    assert held.contains(hashes[15_000:]).all()
    assert held.contains(hashes[:15_000]).mean() < 0.01
    assert (held.table > 0).sum() == len(hashes) - 15_000


@pytest.mark.parametrize("words", [4, 5])
@pytest.mark.parametrize("crowd", [64, 0])
def test_near_copies(odd, odd_rows, words, crowd, monkeypatch):
    monkeypatch.setattr(minhash, "CROWD", crowd)
    sizes, first = brute.near_copies([r[1] for r in odd_rows], words)
    wanted = {r[0]: (n, odd_rows[f][0], odd_rows[f][0] == r[0]) for r, n, f in zip(odd_rows, sizes, first, strict=True)}
    assert by_id(minhash.groups(odd, words), "n_shingles", "component_id", "kept") == wanted
    assert any(not w[2] for w in wanted.values())


def test_near_copies_of_whole_documents(spark, sf_dir, small):
    sizes, first = brute.near_copies([r[1] for r in small], 4)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = minhash.groups(docs, 4)
    assert by_id(found, "n_shingles", "component_id") == {r[0]: (n, small[f][0]) for r, n, f in zip(small, sizes, first, strict=True)}


def test_chains_in_a_crowded_bucket(spark, monkeypatch):
    """Neighbours link, ends don't: the group is one only through its links."""
    monkeypatch.setattr(minhash, "TILE", 8)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i : i + 200]) for i in range(0, 200, 10)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes, first = brute.near_copies(texts, 5)
    assert set(first) == {0}
    for crowd in (64, 0):
        monkeypatch.setattr(minhash, "CROWD", crowd)
        assert {r.component_id for r in minhash.groups(rows, 5).collect()} == {0}


def test_a_crowded_tile_writes_a_tree(spark):
    """All members link with all others: a bucket without any link yet gives fewer links than members, yet one group."""
    shared = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*shared, f"x{i}"])) for i in range(60)]
    docs = spark.createDataFrame(rows, "id long, text string")
    classes = minhash._sketched(docs, 5).select("class", "sketch", F.lit(0).alias("band"), F.lit(0).cast("long").alias("key"), F.lit(60).cast("long").alias("n"))
    sets = minhash._sets_of(docs, minhash._sketched(docs, 5).select("class", "id", "n_shingles"), 5)
    # One band for all: the first in which two sketches agree is not asked for here.
    same = F.concat(F.lit(bytes(8)), F.expr("substring(sketch, 9)"))
    members = classes.withColumn("component", F.col("class")).withColumn("sketch", same)
    pairs = minhash._across(members, 0.5, sets).collect()
    linked = {frozenset(p) for p in pairs}
    assert len(pairs) == len(linked) == 59
    group, open_ = set(), [bytes(pairs[0].a)]
    while open_:
        node = open_.pop()
        group.add(node)
        open_ += [bytes(x) for p in pairs if node in map(bytes, p) for x in p if bytes(x) not in group]
    assert len(group) == 60


def test_one_of_each_group_stays(spark):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(5, text), (5, text), (3, text + " more"), (None, text), (7, ""), (7, ""), (8, None), (9, "alone in the world of words")]
    kept = minhash.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(3, text + " more"), (7, ""), (7, ""), (8, None), (9, "alone in the world of words")], key=repr)


def test_sketches_estimate_similarity():
    chance = np.random.default_rng(5)
    for share in (0.3, 0.8):
        both = chance.integers(0, 2**63, 400).astype(np.uint64)
        n = int(400 * (1 - share) / share / 2)
        one, other = (np.r_[both, chance.integers(0, 2**63, n).astype(np.uint64)] for _ in range(2))
        a, b = (np.frombuffer(minhash.packed(minhash.sketch(x)), np.uint8) for x in (one, other))
        assert abs(minhash.agreement(a, b) - share) < 0.1
    assert len(set(minhash.sketch(np.array([7], np.uint64)).tolist())) == minhash.COORDINATES


@pytest.mark.parametrize("rows_per_task", [7, 500_000])
def test_lines_meet_filters_beyond_the_broadcast_bound(spark, odd, rows_per_task):
    """Every frequent key passes its shard's filter, hardly any other does, and one frequent line is spread over tasks."""
    keys = spark.range(3000).selectExpr("unhex(md5(string(id))) as key", "if(id % 5 = 0, 20L, 1L) as n_docs")
    filters = line_dedup.filters_of(keys, 10, 4)
    lines = keys.selectExpr("unhex(md5('text')) as _text_key", "0 as at", "key").union(spark.range(900).selectExpr("unhex(md5('text'))", "int(id)", "unhex(md5('0'))"))
    found = line_dedup.through_filters(lines, filters, 4, rows_per_task)
    passed = {r["key"]: r["count"] for r in found.groupBy("key").count().collect()}
    frequent = {r["key"] for r in keys.filter("n_docs >= 10").collect()}
    assert frequent <= set(passed) and len(passed) < 620 and max(passed.values()) == 901
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}], ids=["sent", "shuffled"])
@pytest.mark.parametrize("span", [2, 3])
def test_sentence_spans(odd, odd_rows, span, options):
    wanted = brute.sentence_runs([r[1] for r in odd_rows], span, 8)
    found = sentence_spans.dedup(odd, span, 8, **options)
    assert MORE <= set(found.columns)
    assert by_id(found, "n_sentences", "n_removed", "kept") == {r[0]: w for r, w in zip(odd_rows, wanted, strict=True)}
    assert any(w[1] for w in wanted)


def test_short_lines_are_removed(spark):
    """Copied verse, with blank lines and a last line that only a run from before can cover."""
    verse = "\n".join(f"line {w} of verse" for w in "abcdefghijklmno") + "\n" + " \n" * 100 + "the end"
    texts = [verse, "Something else comes first.\n" + verse, verse, "too short.\nto count", "too short.\nto count"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = by_id(sentence_spans.dedup(rows, 2, 10), "n_sentences", "n_removed", "kept")
    assert found == dict(enumerate(brute.sentence_runs(texts, 2, 10)))
    assert found[1][2].startswith("Something else comes first.\n") and found[2][2] == "" and found[4][1] == 0


def test_the_first_run_is_kept(spark):
    text = "One two three four five. Six seven eight nine ten. Own end of {}."
    rows = [(2, text.format("b")), (1, text.format("a")), (None, text.format("c")), (1, text.format("a"))]
    found = sentence_spans.dedup(spark.createDataFrame(rows, "doc_id long, text string"), 2, 10)
    assert sorted((r.doc_id or 9, r.n_removed) for r in found.collect()) == [(1, 0), (1, 0), (2, 2), (9, 2)]


def test_empty_tables(nothing):
    for df in (
        suffix_dedup.dedup(nothing),
        line_dedup.dedup(nothing),
        line_dedup.dedup(nothing, broadcast_bytes=-1),
        minhash.groups(nothing),
        minhash.dedup(nothing),
        sentence_spans.dedup(nothing),
    ):
        assert df.collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    wanted = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert found == wanted
