"""Deduplicating dumps one after the other against deduplicating all of them at once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from moodtide.operators.id_table import IdTable, dedup_new_posts
from moodtide.operators.ingest import dedup_by_id
from moodtide.session import durable

_SCHEMA = "id string, created_utc bigint, body string"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def batches(spark):
    rows = [(f"p{i * 7 % 50}", i, f"text {i}") for i in range(120)]
    rows += [(None, 200, "no id"), (None, 3, "no id before"), ("", 201, "empty id"), ("=", 202, "mark")]
    rows += [("hot", 300 + i % 5, f"copy {i % 3}") for i in range(200)]
    everything = spark.createDataFrame(rows, _SCHEMA).repartition(5)
    bounds = [(-1, 60), (60, 201), (201, 302), (302, 999)]
    return everything, [everything.filter((F.col("created_utc") >= a) & (F.col("created_utc") < b)) for a, b in bounds]


def test_batches_give_the_result_of_one(spark, batches):
    everything, parts = batches
    table = IdTable(spark, buckets=4)
    found = [row for i, part in enumerate(parts) for row in _rows(dedup_new_posts(part, table, f"b{i}"))]
    assert sorted(found, key=str) == _rows(dedup_by_id(everything))
    assert table.read().count() == table.read().select("key").distinct().count() == len(found)


def test_a_batch_run_again_gives_the_same(spark, batches):
    _, parts = batches
    table = IdTable(spark, buckets=4)
    dedup_new_posts(parts[0], table, "first")
    once = _rows(dedup_new_posts(parts[1], table, "second"))
    size = table.read().count()
    assert _rows(dedup_new_posts(parts[1], table, "second")) == once and table.read().count() == size
    assert _rows(dedup_new_posts(parts[1], table, "third")) == []


def test_table_is_opened_again_from_its_path(spark, batches, tmp_path):
    _, parts = batches
    path = str(tmp_path / "it's ids")
    first = _rows(dedup_new_posts(parts[0], IdTable(spark, path, 4), "a"))
    spark.sql(f"DROP TABLE {IdTable(spark, path, 4).name}")
    again = IdTable(spark, path, 4)
    assert again.read().count() == len(first)
    assert _rows(dedup_new_posts(parts[0], again, "b")) == []


def test_empty_batch_and_missing_column(spark, batches):
    table = IdTable(spark, buckets=4)
    assert dedup_new_posts(batches[0].limit(0), table, "none").collect() == []
    with pytest.raises(Exception, match="id"):
        dedup_new_posts(batches[0].drop("id"), table, "none")


def test_the_table_is_not_shuffled(spark, batches):
    table = IdTable(spark, buckets=4)
    keys = batches[0].select(F.concat(F.lit("="), "id").alias("key")).distinct()
    table.append(keys, "a")
    table.append(keys.limit(3), "b")
    text = table.unknown(durable(keys))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Bucketed: true" in text and text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("Bucketed: true")  # the batch's keys


def test_whole_posts_are_not_aggregated_for_ids_seen_once(spark, batches):
    table = IdTable(spark, buckets=4)
    text = dedup_new_posts(batches[1][0], table, "a")._jdf.queryExecution().executedPlan().toString()
    once, repeated = text.index("LeftAnti"), text.index("LeftSemi")
    assert text.index("Union") < once < repeated and "Aggregate" not in text[once:text.index("SortAggregate")]
