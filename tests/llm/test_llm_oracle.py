"""The registered queries give the rows that the same question in DuckDB gives, and every one of them runs whole."""

import pytest

from sparkwell.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op2_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op13_subword_lattice": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op3_source_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op4_permutation_index": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op6_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op7_minhash_near_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op11_spelling_variants": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    "op12_centroid_clustering": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"},
    "op8_embedding_near_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_rows(key, spark, duck, sf_dir):
    df = QUERIES[key](spark, sf_dir)
    answer = duck.execute(ORACLE[key])
    names = [c[0] for c in answer.description]
    assert set(names) == set(df.columns)
    expected = sorted(repr([row[names.index(n)] for n in sorted(names)]) for row in answer.fetchall())
    assert sorted(repr([row[n] for n in sorted(names)]) for row in df.collect()) == expected


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_a_row_for_each_document_or_query(key, spark, sf_dir):
    df = QUERIES[key](spark, sf_dir)
    kinds = dict(df.dtypes)
    assert {c: kinds[c] for c in COLUMNS.get(key, {})} == COLUMNS.get(key, {})
    if "word" in kinds:  # a row for each word instead
        assert df.count() == df.select("word").distinct().count() > 0
        return
    source = "embeddings" if "vec_id" in kinds else "documents"
    n = spark.read.parquet(f"{sf_dir}/{source}.parquet").count()
    assert df.count() == (20 * -(-n // 20) if "query_id" in kinds else n)
