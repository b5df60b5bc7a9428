"""Batches put one by one against one run over all posts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from moodtide.catalog import fixtures as fx, queries
from moodtide.catalog.fixtures import STUDY, rounded
from moodtide.operators import sentiment, trends
from moodtide.operators.cube_store import CubeStore
from moodtide.operators.measures import measured, report_cube
from moodtide.session import durable, scratch_path


def _rows(df):
    df = rounded(df)
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def posts(spark, sf_dir):
    """Tagged posts with some blank months, in three batches that all have posts of the same months."""
    tagged = fx.tagged(spark, sf_dir)
    some = F.crc32(F.col("id").cast("binary"))
    blank = F.when(some % 11 == 0, F.lit("")).otherwise(F.col("year_month"))
    return durable(tagged.withColumn("year_month", blank).withColumn("_b", F.pmod(some, F.lit(3)).cast("int")))


@pytest.fixture
def store(spark, posts):
    store = CubeStore(spark, scratch_path(spark, "cubes"), STUDY)
    for i in range(3):
        store.put(f"2024-{i}", posts.filter(F.col("_b") == i))
    return store


def test_three_batches_equal_one_run(posts, store):
    whole = durable(report_cube(measured(posts, STUDY), STUDY))
    assert _rows(store.cube()) == _rows(whole)
    for table in (trends.monthly_post_totals, trends.topic_monthly_trends_long, sentiment.topic_sentiment_table):
        assert _rows(table(store.cube(), STUDY)) == _rows(table(whole, STUDY))


def test_a_batch_put_again_replaces_itself(spark, posts, store):
    before = _rows(store.cube())
    store.put("2024-1", posts.filter("_b = 1"))
    assert _rows(store.cube()) == before
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    store.put("2024-1", posts.limit(0))
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert _rows(store.cube()) == _rows(report_cube(measured(posts.filter("_b <> 1"), STUDY), STUDY))
    assert {r.batch for r in store.batches().collect()} == {"2024-0", "2024-2"}


def test_a_span_of_months_reads_only_its_folders(posts, store):
    month = posts.agg(F.max("year_month")).first()[0]
    one = store.cube(month, month)
    assert _rows(one) == _rows(report_cube(measured(posts.filter(F.col("year_month") == month), STUDY), STUDY))
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in text


def test_new_store_is_empty_and_names_are_checked(spark, posts):
    store = CubeStore(spark, scratch_path(spark, "cubes"), STUDY)
    assert store.cube().count() == 0 and store.batches().count() == 0
    with pytest.raises(ValueError):
        store.put("a/b", posts)


def test_the_incremental_query_reads_the_texts_once(spark, sf_dir, monkeypatch):
    put = []
    monkeypatch.setattr(CubeStore, "put", lambda self, batch, tagged: put.append(tagged._jdf.queryExecution().executedPlan().toString()))
    queries.incremental_monthly_trends(spark, sf_dir)
    assert len(put) == 3 and not any("documents.parquet" in plan for plan in put)
