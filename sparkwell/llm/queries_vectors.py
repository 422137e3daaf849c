"""The registered queries on whole embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkwell.llm import centroid_clustering, embedding_dedup, permutation_index
from sparkwell.llm.registry import query
from sparkwell.tables import table


@query(
    "op8_embedding_near_dedup",
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding]) AND list_bool_or([x <> 0 FOR x IN embedding])
    ), links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE list_cosine_similarity(a.e, b.e) >= 0.9
    ), reach(id, other) AS (
        SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
    )
    SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
           coalesce((SELECT min(other) FROM reach r WHERE r.id = e.vec_id), e.vec_id) AS component_id,
           coalesce((SELECT min(other) FROM reach r WHERE r.id = e.vec_id), e.vec_id) = e.vec_id AS kept
    FROM embeddings e
    """,
)
def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.groups(table(spark, sf_dir, "embeddings"), cosine=0.9)


@query("op4_permutation_index")
def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return permutation_index.nearest(rows, rows.filter("vec_id % 20 = 0"), k=20)


def _round_sql(turn: int) -> str:
    """One assignment of all vectors to the centroids of a round, and the centroids after it."""
    return f"""
    near{turn} AS (
        SELECT id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
            SELECT v.id, k.c, sum((v.x - k.x) * (v.x - k.x)) AS d FROM v JOIN k{turn} k ON v.i = k.i GROUP BY v.id, k.c
        ) GROUP BY id
    ), k{turn + 1} AS (
        SELECT k.c, k.i, coalesce(m.x, k.x) AS x FROM k{turn} k LEFT JOIN (
            SELECT n.c, v.i, CAST(floor(sum(v.x)::DOUBLE / count(*)) AS BIGINT) AS x FROM v JOIN near{turn} n ON v.id = n.id GROUP BY n.c, v.i
        ) m ON k.c = m.c AND k.i = m.i
    )"""


@query(
    "op12_centroid_clustering",
    f"""
    WITH rows AS (
        SELECT row_number() OVER () AS id, vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE len(embedding) = 64 AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
    ), v AS (
        SELECT id, generate_subscripts(e, 1) AS i, CAST(floor(64 * unnest(e)) AS BIGINT) AS x FROM rows
    ), k0 AS (
        SELECT s.c, v.i, v.x FROM v JOIN (
            SELECT id, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS c FROM rows
        ) s ON v.id = s.id WHERE s.c < 16
    ), {",".join(_round_sql(turn) for turn in range(4))}
    SELECT vec_id, CAST(n.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
           CAST(sum(d) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
    FROM rows r JOIN near3 n ON r.id = n.id
    JOIN (SELECT c, sha256(string_agg(x, ',' ORDER BY i)) AS centroid_sha256 FROM k3 GROUP BY c) h ON n.c = h.c
    """,
)
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, scale=64, dims=64)
