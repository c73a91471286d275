"""The corpus pipeline: toxic documents go, one document of each near-duplicate class
stays, personal data is replaced, sources are mixed to their target weights, and texts are
encoded by sampled SentencePiece segmentation.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns a
DataFrame with the columns of ``documents``; the last returns the encoded rows.  No stage
can be written in SQL that DuckDB runs with the same result, so ORACLE_SQL is None and the
tests hold the pipeline against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import read_table, stored
from salesmart.llm.mixing import mixture, repeated
from salesmart.llm.order_minhash import deduplicated
from salesmart.llm.pii import redacted
from salesmart.llm.queries import MODEL_PATH
from salesmart.llm.sp_sampling import encode
from salesmart.llm.toxicity import held_out, learn, scored

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score, learned from the labels of ``docs``, is below 0.5."""
    model = learn(docs, read_table(spark, sf_dir, "labels").where(~held_out()))
    return scored(docs, model, score_col="_score").where("_score < 0.5").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return deduplicated(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars counts the new text."""
    out = redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of each document as the mix takes copies of it."""
    return repeated(mixture(docs), docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_pieces and the sampled ids of every row."""
    return encode(docs, MODEL_PATH)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing),
          ("sentencepiece", sentencepiece)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
