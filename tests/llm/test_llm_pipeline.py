"""Every stage of the pipeline against the plain way to do it, on what the stage before it kept."""

import os
import shutil
import subprocess
import sys

import llm_brute as brute
import numpy as np
import pytest
from llm_cases import nothing, odd, odd_rows, small  # noqa: F401

import corpus_pipeline
from sparkwell.llm import language_id, mixing
from sparkwell.llm.queries_text import MODEL_PATH
from sparkwell.llm.shared import stored

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


@pytest.fixture(scope="module", params=["documents", "odd"])
def kept(request, spark, sf_dir, odd):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if request.param == "documents" else odd
    steps, columns = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"test-{name}")
        assert name == "sentencepiece" or docs.columns == columns
        steps.append(docs)
    return steps


def rows(df):
    return sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id))


def test_language(kept):
    before, after = rows(kept[0]), {r.doc_id: r for r in rows(kept[1])}
    model = language_id.train(kept[0].filter(~language_id.held_out("doc_id")))
    names, score, lead = model.predict([r.text or "" for r in before])
    for r, name, s, d in zip(before, names, score, lead, strict=True):
        stays = name != "und" and s >= 0.3 and d >= 0.02
        assert (r.doc_id in after) == stays
        if stays:
            assert after[r.doc_id].text == r.text and after[r.doc_id].lang == (r.lang or name)
    assert len(after) > 0.9 * sum(any(c.isalpha() for c in r.text or "") for r in before)


def test_lines(kept):
    before, after = rows(kept[1]), rows(kept[2])
    wanted = [text if n else r.text for r, (_, n, text) in zip(before, brute.common_lines([r.text for r in before], 10), strict=True)]
    assert [r.text for r in after] == wanted
    assert all(r.n_chars == len(r.text) for b, r in zip(before, after, strict=True) if b.text != r.text)


def test_near_copies(kept):
    before = rows(kept[2])
    _, first = brute.near_copies([r.text for r in before], 5)
    assert [r.doc_id for r in rows(kept[3])] == [r.doc_id for i, r in enumerate(before) if first[i] == i]


def test_mix(kept):
    before, after = rows(kept[3]), rows(kept[4])
    size = {r.doc_id: len(brute.WORD.findall(r.text or "")) for r in before}
    total, taken = {}, {}
    for r in before:
        total[r.source] = total.get(r.source, 0) + size[r.doc_id]
    for r in after:
        taken[r.source] = taken.get(r.source, 0) + size[r.doc_id]
    aim = mixing.targets(total, mixing.cyclic_weights(list(total), (3, 1, 2)), 1.5, 2)
    for s, words in total.items():
        full = min(int(aim[s] // words), 2) if words else 0
        rest, sums = int(aim[s] - full * words + 0.5), 1
        for r in before if full < 2 else []:
            if r.source == s:
                sums |= sums << size[r.doc_id] & ((1 << rest + 1) - 1)
        assert taken.get(s, 0) == full * words + sums.bit_length() - 1
    times = np.unique([r.doc_id for r in after], return_counts=True)[1]
    assert times.max() <= 2


def test_tokens(kept):
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    before, after = rows(kept[4]), rows(kept[5])
    assert [r.ids for r in after] == theirs.encode([r.text for r in before])
    assert all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in after)


def test_run_is_the_stages_in_a_row(spark, sf_dir, kept, request):
    if "odd" in request.node.name:
        pytest.skip("run() reads documents")
    found = corpus_pipeline.run(spark, sf_dir)
    assert [(r.doc_id, r.ids_sha256) for r in rows(found)] == [(r.doc_id, r.ids_sha256) for r in rows(kept[5])]


def test_stages_take_empty_tables(spark, nothing, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).collect() == []


def test_every_operator_has_its_query():
    import __spark_entry__

    names = [k.split("_")[0] for k in __spark_entry__.queries() if k.startswith("op")]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "minhash_near_dedup", "source_mixing", "sentencepiece"]


def test_the_rest_works_without_these_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; assert not any(k.startswith('op') and k[2].isdigit() for k in e.queries()); assert 'pipeline' not in e.queries(); print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) > 150
