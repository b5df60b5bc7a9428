"""Stored models and topic definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moodtide.operators.models import MODEL_COLUMNS


def write_model(model: DataFrame, path: str) -> None:
    """The model table; a few files, since it is bounded by the vocabulary cap."""
    model.select(*MODEL_COLUMNS).coalesce(1).write.parquet(path)


def read_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("term string, idf double, coefficient double").parquet(path)


def write_topic_definitions(definitions: DataFrame, path: str) -> None:
    """One JSON object per topic, in order."""
    rows = definitions.orderBy("topic_ord").select("topic_bucket", "topic_description", "keywords")
    rows.coalesce(1).write.json(path)


def read_topic_definitions(spark: SparkSession, path: str) -> DataFrame:
    schema = "topic_bucket string, topic_description string, keywords array<string>"
    return spark.read.schema(schema).json(path)


def write_partitioned_posts(tagged: DataFrame, path: str) -> None:
    """Large stage output: Parquet by month, so later month filters prune partitions.

    Rebalancing gathers a month's rows into few files, and splits a month that is far larger than
    the rest over as many tasks as its size asks for.
    """
    tagged.hint("rebalance", "year_month").write.partitionBy("year_month").parquet(path)
