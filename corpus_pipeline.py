"""The training-data pipeline: toxicity, line dedup, near-dedup, mixing, and byte-level BPE.

Each stage takes what the one before kept and returns the columns of ``documents``; the
last one returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.llm import toxicity as tox
from cubeloom.llm.byte_bpe import round_trip_documents
from cubeloom.llm.common import small_batches, stored, table
from cubeloom.llm.line_dedup import dedup_lines
from cubeloom.llm.mixing import mix
from cubeloom.llm.simhash_dedup import drop_near_documents


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the lexicon is learned from the labelled training rows."""
    small_batches(spark)
    model = tox.learn(docs, table(spark, sf_dir, "labels"))
    return tox.score_documents(docs, model).where("predicted = 0").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines repeated over documents go, except in one document each; ``n_chars`` follows the text."""
    small_batches(spark)
    return dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays."""
    small_batches(spark)
    return drop_near_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of all tokens, dealt by the production weights; no document comes twice."""
    return mix(docs, fraction=0.9, max_epochs=1).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of the text decoded from them."""
    small_batches(spark)
    return round_trip_documents(docs.select("doc_id", "lang", "source", "text")).select(
        "doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("near dedup", near_dedup), ("mixing", mixing), ("byte bpe", byte_bpe)]
ORACLE_SQL = None  # fitted scores, 64-bit text hashes and merges by rank are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
