"""The registered queries on whole documents: each applies its operator and derives the columns that are asked for."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.llm import language_id, line_dedup, minhash, mixing, sentence_spans, sentencepiece_tokens, spelling_variants, subword_lattice, suffix_dedup, weak_quality
from sparkwell.llm.registry import query
from sparkwell.tables import table


#: Where the public model file lies; set SENTENCEPIECE_MODEL to take another.
MODEL_PATH = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query(
    "op6_line_dedup",
    r"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ), keyed AS (
        SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines
    ), frequent AS (
        SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
    )
    SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
    FROM keyed k LEFT JOIN frequent f ON k.key = f.key
    GROUP BY doc_id
    """,
)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(documents(spark, sf_dir), min_docs=10)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_source_mixing")
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = mixing.decide(docs, weights=(3, 1, 2), share=1.5, most=2)
    return found.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentencepiece_tokens.encode(documents(spark, sf_dir), sentencepiece_tokens.model_bytes(MODEL_PATH), with_ids=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "parity", "round_trip")


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    aside = language_id.held_out("doc_id")
    model = language_id.train(docs.filter(~aside))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", aside.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op7_minhash_near_dedup")
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.groups(documents(spark, sf_dir), words=4, similarity=(80, 100))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(documents(spark, sf_dir), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op9_sentence_spans",
    r"""
    WITH sentences AS (
        SELECT doc_id, unnest(regexp_extract_all(text, '[^.!?\n]+[.!?\n]*|[.!?\n]+')) AS sentence,
               generate_subscripts(regexp_extract_all(text, '[^.!?\n]+[.!?\n]*|[.!?\n]+'), 1) AS pos
        FROM documents
    ), keyed AS (
        SELECT *, translate(trim(sentence, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM sentences
    ), summed AS (
        SELECT doc_id, pos, key, len(regexp_extract_all(key, '[^\x20\x09-\x0D]+')) AS words,
               sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto, upto - words AS before
        FROM keyed
    ), whole AS (
        SELECT doc_id, list(key ORDER BY pos) AS keys, max(pos) AS n, max(upto) AS total FROM summed GROUP BY doc_id
    ), ends AS (
        SELECT doc_id, upto, min(pos) AS pos FROM summed GROUP BY doc_id, upto
    ), bounds AS (
        SELECT s.doc_id, s.pos AS first, greatest(e.pos, s.pos + 1) AS last
        FROM summed s ASOF JOIN ends e ON s.doc_id = e.doc_id AND e.upto >= s.before + 10
        UNION
        SELECT s.doc_id, max(s.pos), any_value(n) FROM summed s JOIN whole w ON s.doc_id = w.doc_id
        WHERE s.pos < n AND total - before >= 10 GROUP BY s.doc_id
    ), ranked AS (
        SELECT b.doc_id, first, last, row_number() OVER (PARTITION BY keys[first:last] ORDER BY b.doc_id, first) AS turn
        FROM bounds b JOIN whole w ON b.doc_id = w.doc_id
        WHERE last <= n
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS pos FROM ranked WHERE turn > 1
    ), counted AS (
        SELECT k.doc_id, count(*) AS n_sentences, count(g.pos) AS n_removed,
               coalesce(string_agg(sentence, '' ORDER BY k.pos) FILTER (WHERE g.pos IS NULL), '') AS kept
        FROM keyed k LEFT JOIN gone g ON k.doc_id = g.doc_id AND k.pos = g.pos
        GROUP BY k.doc_id
    )
    SELECT d.doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id
    """,
)
def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentence_spans.dedup(documents(spark, sf_dir), span=2, least_words=10)
    return found.select("doc_id", "n_sentences", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_weak_quality")
def op10_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model, scorer = weak_quality.train(docs)
    return weak_quality.score(docs, model, scorer).select("doc_id", "posterior", "score", "kept")


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 199th run by hash of document and run loses one code point before words are counted."""
    runs = spelling_variants.runs(documents(spark, sf_dir), least_length=6)
    mark = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), "word").cast("binary"))
    at = F.pmod(mark, F.length("word")).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    words = runs.select(F.when(F.pmod(mark, F.lit(199)) == 0, shorter).otherwise(F.col("word")).alias("word"))
    return spelling_variants.variants(spelling_variants.counted(words, least_length=6, least_n=5), times=5)


@query("op13_subword_lattice")
def op13_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the training documents are the classes; the language of a document that is scored is never read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return subword_lattice.log_probabilities(docs, sentencepiece_tokens.model_bytes(MODEL_PATH), class_col="lang")
