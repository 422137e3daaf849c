"""The corpus pipeline: five stages over ``documents``, each the operator of its name on all that the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which :func:`run` writes as Parquet
to the shared folder and reads again for the next one; a stage's intermediate tables go when its rows are
written, the rows themselves when the next stage's are. All but the last return the columns of ``documents``.

1. ``language_id``: documents whose language can't be told go: without a letter, or about as near to one codeword as
   to another. A null ``lang`` is filled with the prediction; others are left as they came.
2. ``line_dedup``: lines found in at least ten documents go; ``text`` is what is left and ``n_chars`` its length.
3. ``minhash_near_dedup``: one document of each group of near copies stays (five words, similarity 0.8).
4. ``source_mixing``: each document as often as the mix takes it, so a repeated one has several rows.
5. ``sentencepiece``: token ids of each row, with the checks of parity and round trip.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.llm import language_id, line_dedup, minhash, mixing, sentencepiece_tokens
from sparkwell.llm.queries_text import MODEL_PATH
from sparkwell.storage import delete, new_path, passing
from sparkwell.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents outside the held-out fold that carry a language."""
    model = language_id.train(docs.filter(~language_id.held_out("doc_id")))
    names = docs.columns
    found = language_id.predict(docs, model, least_score=0.3, least_lead=0.02)
    told = found.filter((F.col("lang_pred") != language_id.UNDETERMINED) & ~F.col("ambiguous"))
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*names)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A text that loses no line stays as it is, null included."""
    names = docs.columns
    found = line_dedup.dedup(docs, min_docs=10)
    changed = F.col("n_dropped") > 0
    return (
        found.withColumn("text", F.when(changed, F.col("kept")).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")))
        .select(*names)
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.dedup(docs, words=5, similarity=(80, 100))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by code point weigh 3, 1, 2, repeating, and share 150 % of all words."""
    return mixing.mixed(docs, weights=(3, 1, 2), share=1.5, most=2)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_tokens.encode(docs, sentencepiece_tokens.model_bytes(MODEL_PATH))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_common_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode),
]

#: The stages hold a trained model, sketches, a knapsack and a tokenizer, which SQL can't express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with passing(spark) as written:
            kept = stage(spark, docs, sf_dir)
            path = new_path(spark, f"pipeline-{name}")
            kept.write.parquet(path)
            written.remove(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before is not None:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
