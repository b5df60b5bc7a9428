"""A corpus pipeline: toxicity, exact dedup, near dedup, mixing and byte-pair encoding, in this order."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from moodtide.llm import bpe, exact_dedup, mixing, near_dedup, toxicity  # noqa: E402
from moodtide.llm.common import table  # noqa: E402
from moodtide.llm.queries import toxicity_model  # noqa: E402
from moodtide.session import durable  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels of the whole table."""
    return toxicity.drop_toxic(docs, toxicity_model(spark, sf_dir))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest doc_id."""
    return exact_dedup.keep_one_per_text(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8), the one with the smallest doc_id."""
    return near_dedup.keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources, each document as often as it is taken."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of the text that the ids decode to, for each row of the mix."""
    return bpe.encode_and_check(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The classifier and MinHash cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
