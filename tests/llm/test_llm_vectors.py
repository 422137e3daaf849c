"""Embedding near-dedup and the permutation index against brute force."""

import math

import llm_brute as brute
import numpy as np
import pytest

from sparkwell.llm import embedding_dedup, permutation_index

SCHEMA = "vec_id long, embedding array<float>, n_links string, score string, class string, id string"


def odd_vectors():
    chance = np.random.default_rng(8)
    base = chance.standard_normal((60, 16))
    rows = [v for v in base] + [v + 0.05 * chance.standard_normal(16) for v in base[:20]] + [3 * base[5], base[7], base[7]]
    turning = [np.r_[math.cos(k * 0.4), math.sin(k * 0.4), np.zeros(14)] for k in range(5)]  # neighbours link, ends don't
    rows = [[float(np.float32(x)) for x in v] for v in [*rows, *turning]]
    rows += [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15]
    rows += [[1.0, 2.0], [1.0, 2.125], [-0.0, 1.0], [0.0, 1.0]]
    return list(enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "n", "s", "c", "x") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("tile", [512, 4])
def test_close_vectors(spark, tile, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rows = odd_vectors()
    links, first = brute.close_vectors([v for _, v in rows], 0.9)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.groups(frame(spark, rows)).collect()}
    assert found == {i: (n, f, f == i) for (i, _), n, f in zip(rows, links, first, strict=True)}
    assert sum(links) > 50


def test_repeated_rows_without_ids(spark):
    v = [1.0, 0.0, 0.5]
    rows = [(4, v), (4, v), (None, v), (9, [0.0, 1.0, 0.0]), (None, [0.0, 0.0, -1.0])]
    found = sorted((tuple(r) for r in embedding_dedup.groups(frame(spark, rows)).collect()), key=repr)
    assert found == sorted([(4, 2, 4, True), (4, 2, 4, True), (None, 2, 4, False), (9, 0, 9, True), (None, 0, None, True)], key=repr)


def test_recall_just_at_the_cosine(spark):
    """Pairs at 0.905 in many dimensions, where a projection tells little."""
    chance = np.random.default_rng(9)
    one = chance.standard_normal((600, 48))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    side = chance.standard_normal((600, 48))
    side -= (side * one).sum(axis=1, keepdims=True) * one
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    other = 0.905 * one + math.sqrt(1 - 0.905**2) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.r_[one, other])]
    found = {r.vec_id: r.component_id for r in embedding_dedup.groups(frame(spark, rows), cell_rows=32).collect()}
    assert sum(found[600 + i] == i for i in range(600)) >= 594


def test_plan_follows_the_size():
    plans = [embedding_dedup.Plan(0.9, n, 0.999, 512) for n in (10**3, 10**5, 10**7, 10**9)]
    assert all(a.depth < b.depth and a.bands < b.bands for a, b in zip(plans, plans[1:], strict=False))
    assert plans[-1].bands < 400 and all(0 < p.least < embedding_dedup.PROJECTIONS for p in plans)


def nearest_by_hand(rows, query, k):
    sound = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    own = dict(rows)[query]
    score = [(-float(np.dot(np.array(v, float), np.array(own, float))), i) for (i, v), s in zip(rows, sound, strict=True) if s and i != query and len(v) == len(own)]
    return [i for _, i in sorted(score)[:k]]


def test_exact_when_everything_is_read(spark):
    rows = [r for r in odd_vectors()]
    df = frame(spark, rows)
    found = permutation_index.nearest(df, df.filter("vec_id % 5 = 0"), k=20, probe_share=1.0, share=1.0).collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    for q in range(0, len(rows), 5):
        v = rows[q][1]
        if v is None or not v or not all(x is not None and math.isfinite(x) for x in v) or not any(v):
            assert q not in got
            continue
        wanted = nearest_by_hand(rows, q, 20)
        mine = got.get(q, {})
        assert sorted(mine) == list(range(1, len(wanted) + 1))
        for place, i in enumerate(wanted, 1):
            assert abs(mine[place][1] - float(np.dot(np.array(rows[i][1], float), np.array(v, float)))) < 1e-9
        assert [mine[k][0] for k in sorted(mine)] == wanted or len({round(s, 9) for _, s in mine.values()}) < len(mine)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [0.5, 0.0])]
    df = frame(spark, rows)
    found = permutation_index.nearest(df, df.filter("vec_id in (3, 40, 100)"), k=5).collect()
    got = {q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (3, 40, 100)}
    assert got == {3: [0, 1, 2, 4, 5], 40: [0, 1, 2, 3, 4], 100: [0, 1, 2, 3, 4]}


def test_recall(spark, sf_dir):
    """At least 0.9 of the true 20 nearest among vectors without structure, the hardest case."""
    chance = np.random.default_rng(10)
    x = chance.standard_normal((4000, 64)).astype(np.float32).astype(float)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    found = {}
    for r in permutation_index.nearest(df, df.filter("vec_id % 20 = 0"), k=20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in range(0, 4000, 20):
        score = x @ x[q]
        score[q] = -np.inf
        hits.append(len(found[q] & set(np.argsort(-score)[:20].tolist())))
    assert np.mean(hits) / 20 >= 0.9


def test_recall_among_almost_equal_vectors(spark):
    """The pivots' order tells nothing within a group whose members differ by far less than from any pivot."""
    chance = np.random.default_rng(11)
    x = chance.standard_normal((5000, 64))
    x[:1500] = x[0] + 0.001 * chance.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in permutation_index.nearest(rows, rows.filter("vec_id < 1500 and vec_id % 50 = 0"), k=20, pivots=16).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in range(0, 1500, 50):
        score = x @ x[q]
        score[q] = -np.inf
        hits.append(len(found[q] & set(np.argsort(-score)[:20].tolist())))
    assert np.mean(hits) / 20 >= 0.99


def found_share(rows, x, step, **settings):
    """The share of the true 20 nearest that every ``step``-th vector finds."""
    found = {}
    for r in permutation_index.nearest(rows, rows.filter(f"vec_id % {step} = 0"), k=20, **settings).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in range(0, len(x), step):
        score = x @ x[q]
        score[q] = -np.inf
        hits.append(len(found[q] & set(np.argsort(-score)[:20].tolist())))
    return np.mean(hits) / 20


def test_few_vectors_are_all_read(spark):
    """However little their order of pivots tells: 6,000 vectors without structure."""
    x = np.random.default_rng(12).standard_normal((6000, 64)).astype(np.float32).astype(float)
    assert found_share(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), x, 20) == 1


@pytest.mark.parametrize(("groups", "posting"), [(0, 8192), (0, 0), (60, 8192)])
def test_depth_is_learned(spark, groups, posting, monkeypatch):
    """Queries read as deep as a sample of them needs, with structure and without, in several blocks, parts of files and indexes."""
    monkeypatch.setattr(permutation_index, "POSTING", posting)
    chance = np.random.default_rng(13)
    x = chance.standard_normal((6000, 32))
    if groups:
        x = 0.15 * x + chance.standard_normal((groups, 32))[chance.integers(0, groups, 6000)]
    x = x.astype(np.float32).astype(float)
    rows = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    assert found_share(rows, x, 30, pivots=32, least_read=0, share=0.0, part=100, block_bytes=100 * (32 * 4 + 32 + 16)) >= 0.95


def test_no_query_goes_short(spark):
    """However shallow the sample lets queries read, each gets as many rows as there are."""
    x = np.random.default_rng(15).standard_normal((1500, 16))
    rows = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    found = permutation_index.nearest(rows, rows.filter("vec_id % 10 = 0"), k=20, pivots=64, least_read=0, share=0.0, recall=1e-9, turns=1)
    assert found.count() == 150 * 20


def test_one_file_of_all(spark):
    """A few rows more than fill the tiles of the first pass."""
    x = np.random.default_rng(14).standard_normal((4100, 4)).astype(np.float32).astype(float)
    assert found_share(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), x, 100, pivots=1) == 1


def test_no_vectors(spark):
    none = frame(spark, [])
    assert permutation_index.nearest(none, none).collect() == []
    assert embedding_dedup.groups(none).collect() == []
    unusable = frame(spark, [(0, None), (20, [0.0])])
    assert permutation_index.nearest(unusable, unusable).collect() == []
