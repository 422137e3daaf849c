"""Spelling variants against plain edit neighbourhoods."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import nothing, odd, odd_rows, small  # noqa: F401

from sparkwell.llm import spelling_variants as sv
from sparkwell.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary_by_hand(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            found[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def variants_by_hand(words, times=5):
    """(word, form, root, n, n_near, form_n) by words with one place cut out or left open."""
    shapes, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shapes[w[:i], w[i + 1 :], True].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in shapes.values():
        for w in group if len(group) > 1 else ():
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()), key=repr)


def found(spark, words, **tiles):
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    rows = sv.variants(table, **tiles).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("members, searchers", [(4096, 16_384), (20, 30), (3, 2)])
def test_same_variants(spark, members, searchers):
    """Dense words over few letters, anagrams, words of one vector, long words; tiles of every size give the same answer."""
    chance = random.Random(3)
    words = {"".join(chance.choice("abcé") for _ in range(chance.randint(6, 7))): int(5 * 6 ** chance.randint(0, 4)) + chance.randint(0, 9) for _ in range(500)}
    words |= {"".join(chance.sample("aaabbbcc", 8)): 7 for _ in range(60)}
    words |= {"x" * k: 10 * k for k in (6, 7, 63, 64, 65, 66, 254, 255, 256, 257, 300)}
    words |= {"long" * 30 + tail: n for tail, n in (("", 500), ("a", 6), ("b", 5000), ("ab", 5), ("\U0001d538", 9))}
    assert found(spark, words, members=members, searchers=searchers) == variants_by_hand(words)


def test_forms_lead_to_a_root(spark):
    words = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abijhg": 9999, "abidhg": 625, "zzzzzz": 5, "zzzzzy": 24, "zzzzzx": 24}
    assert found(spark, words) == variants_by_hand(words)
    told = {r[0]: r for r in found(spark, words)}
    assert told["abcdef"][1:3] == ("abcdeg", "abijhg") and told["zzzzzz"][1:] == (None, "zzzzzz", 5, 2, None)


def test_ties_go_to_the_smaller_word(spark):
    words = {"shared": 6, "sharad": 60, "sharéd": 60, "sharod": 60}
    assert {r[0]: r[1] for r in found(spark, words)}["shared"] == "sharad"


@pytest.mark.parametrize("a, b, near", [("abc", "abd", True), ("abc", "abcd", True), ("abc", "zabc", True), ("abc", "acb", False), ("abc", "abc", False), ("", "a", True), ("ab", "abcd", False), ("aab", "ab", True)])
def test_one_edit(a, b, near):
    assert sv.one_edit(a, b) is near and sv.one_edit(b, a) is near


def test_reached_nodes_are_those_within_the_budget():
    """Every vector whose first difference is a surplus, with one deficit at most behind it."""
    word = np.array([[2, 0, 1, 255]], np.uint8)
    got = {tuple(path[0].tolist()): int(cost[0]) for at, path, cost in sv.reached(word, np.zeros(1, np.int32), 0, 4) if len(at)}
    assert got == {(2, 0, 1, 255): 0, (3, 0, 1, 255): 1, (3, 0, 0, 255): 2, (3, 0, 1, 254): 2, (2, 1, 1, 255): 1, (2, 1, 0, 255): 2, (2, 1, 1, 254): 2, (2, 0, 2, 255): 1, (2, 0, 2, 254): 2}


def test_query_on_odd_texts(spark, odd, odd_rows, tmp_path):
    rows = [(None if i == 50 else i, t) for i, t, _, _ in odd_rows]
    shifted = odd.selectExpr("* except (doc_id)", "if(doc_id = 50, null, doc_id) as doc_id")
    shifted.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in QUERIES["op11_spelling_variants"](spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)
    assert got == variants_by_hand(vocabulary_by_hand(rows)) and len(got) > 50


def test_query_on_documents(spark, sf_dir, small):
    got = sorted((tuple(r) for r in QUERIES["op11_spelling_variants"](spark, sf_dir).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)
    assert got == variants_by_hand(vocabulary_by_hand([(i, t) for i, t, _, _ in small]))
    assert any(r[1] for r in got) and any(r[4] for r in got)


def test_nothing(spark, nothing):
    empty = sv.counted(sv.runs(nothing))
    assert sv.variants(empty).collect() == []
    assert sv.variants(spark.createDataFrame([("single", 9)], "word string, n long")).collect()[0].root == "single"
