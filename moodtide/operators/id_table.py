"""A persistent table of known ids, so that a new dump is deduplicated without reading the earlier ones again.

The table holds one narrow row per id, bucketed and sorted by it. A batch's distinct ids meet it in a sort-merge
join that shuffles only the batch's side and reads each bucket in one task. Whole posts move only where an id is repeated in the batch or was known.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.operators.guards import require_columns
from moodtide.operators.ingest import dedup_by_id
from moodtide.session import durable, scratch_path

#: Buckets of a new table: about the ids expected over the ids that one task should merge.
BUCKETS = 32


def _key(id_: Column) -> Column:
    """The id as a join key; rows without an id share one, as in ``dedup_by_id``."""
    return F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit(""))


class IdTable:
    """(key, batch) of all ids seen, below a folder that all executors share.

    The table is external: a later session opens it from its path and number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        path = path or scratch_path(spark, "ids")
        self.spark, self.buckets = spark, buckets
        self.name = "id_table_" + hashlib.md5(path.encode()).hexdigest()
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (key STRING, batch STRING) USING parquet "
            f"CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{location}'"
        )

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unknown(self, keys: DataFrame, before: str | None = None) -> DataFrame:
        """The rows of ``keys`` whose key no batch has, or no batch but ``before``."""
        known = self.read() if before is None else self.read().filter(F.col("batch") != before)
        return keys.join(known.select("key").hint("merge"), "key", "left_anti")

    def append(self, keys: DataFrame, batch: str) -> None:
        """Add keys, one file per bucket."""
        dealt = keys.select("key", F.lit(batch).alias("batch")).repartition(self.buckets, "key")
        dealt.sortWithinPartitions("key").write.insertInto(self.name)


def dedup_new_posts(
    posts: DataFrame, table: IdTable, batch: str, order_by: tuple[str, ...] | None = None
) -> DataFrame:
    """The first post of each id that no earlier batch had; the ids are added to the table.

    Batches given one after the other give together what ``dedup_by_id`` gives for all of them, if every row of a
    batch comes before those of the next. ``batch`` names the batch: one that is run again under its name, after
    a failure for example, gives the same posts and adds no id twice. Rows without an id count as one id. An empty
    batch gives no rows. ``order_by`` is that of ``dedup_by_id``.
    """
    require_columns(posts, ("id",))
    keys = durable(posts.groupBy(_key(F.col("id")).alias("key")).agg(F.count(F.lit(1)).alias("n")))
    fresh = durable(table.unknown(keys, before=batch))
    table.append(table.unknown(fresh.select("key")), batch)
    repeated = fresh.filter(F.col("n") > 1).select(F.col("key").alias("_key"))
    known = keys.join(fresh, "key", "left_anti").select(F.col("key").alias("_key"))
    special = durable(repeated.unionByName(known))
    on = _key(F.col("id")) == F.col("_key")
    once = posts.join(special, on, "left_anti")
    return once.unionByName(dedup_by_id(posts.join(durable(repeated), on, "left_semi"), order_by))
