"""Exact deduplication against a persistent digest index.

The index is a table of the digests of all texts ever kept, bucketed and sorted by digest, so that
new data meets it in a sort-merge anti-join that moves only the new digests. A document is known by
the SHA-256 of its text after lower-casing A-Z; texts do not travel to find the duplicates.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.llm import bloom
from moodtide.llm.common import ascii_lower
from moodtide.session import durable, scratch_path

#: Buckets of a new index: choose about the digests expected over the digests one task should merge.
BUCKETS = 32


def text_digest(text: Column | str) -> Column:
    """SHA-256 (binary) of the normalised text in UTF-8; null counts as empty text."""
    return F.unhex(F.sha2(ascii_lower(text).cast("binary"), 256))


class DigestIndex:
    """The digests of all kept texts: (digest, keep_id, batch), a Parquet table bucketed and sorted by digest.

    ``path`` is a folder that all executors share. The table is external, so a later session opens the
    same index from its path and bucket count.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, rows: DataFrame, batch: str) -> None:
        """Add (digest, keep_id) rows that the index does not hold yet, one file per bucket."""
        dealt = rows.select("digest", "keep_id", F.lit(batch).alias("batch")).repartition(self.buckets, "digest")
        dealt.sortWithinPartitions("digest").write.insertInto(self.name)


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the application's scratch folder."""
    return DigestIndex(spark, scratch_path(spark, "digests"))


def resolve_batch(digests: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """Add the new digests of a batch to the index and return what stays for each of its digests.

    ``digests`` has (doc_id, digest). Returns a written table (digest, keep_id, group_size, is_new).
    ``batch`` names the batch: a batch that is run again under its name, after a failure for example,
    gives the same answer and adds nothing twice.

    Each group is reduced to one row on the map side; its size never meets one task.
    """
    batch = batch or uuid.uuid4().hex
    groups = durable(
        digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    index.append(groups.hint("merge").join(index.read().select("digest"), "digest", "left_anti"), batch)
    indexed = index.read().select("digest", "keep_id", (F.col("batch") == batch).alias("is_new"))
    return durable(groups.drop("keep_id").hint("merge").join(indexed, "digest"))


def _is_kept() -> Column:
    return F.col("is_new") & F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False))


def exact_dedup(
    docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size (rows of the batch with this text), kept.

    A text that the index already holds keeps its earlier id and no row of the batch is kept; otherwise
    the row with the largest doc_id stays. Without an index a new empty one is used.

    Null text: empty text; empty texts are equal to each other. Null doc_id: smaller than any other; a
    group of only such rows has a null keep_id and keeps none. Repeated rows (same id, same text): all
    marked kept. An empty table gives no rows. Other columns are ignored, whatever their names.

    The join back to the rows is an ordinary sort-merge join of two written tables, so Spark splits the
    partition of a hot text.
    """
    digests = durable(docs.select(F.col(doc_id).alias("doc_id"), text_digest(text).alias("digest")))
    resolved = resolve_batch(digests, index or new_index(docs.sparkSession), batch)
    return digests.join(resolved, "digest").select("doc_id", "digest", "keep_id", "group_size", _is_kept().alias("kept"))


def keep_one_per_text(
    docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """The rows that stay, with all their columns: one per text that the index does not hold yet.

    Rows whose text occurs once pass a Bloom filter of the repeated and the known digests where they
    are and are not shuffled; only possible hits are joined. Repeated rows (same id, same text) are
    reduced to one; of a group without any doc_id one row stays. Otherwise as ``exact_dedup``.
    """
    digests = docs.select(F.col(doc_id).alias("doc_id"), text_digest(text).alias("digest"))
    resolved = resolve_batch(digests, index or new_index(docs.sparkSession), batch)
    repeated = resolved.filter((F.col("group_size") > 1) | ~F.col("is_new"))
    filled = bloom.build(repeated.select(F.xxhash64("digest").alias("h")), repeated.count())
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("doc_id"), text_digest(text).alias("digest"))
    probed = rows.withColumn("listed", bloom.may_contain(rows, filled, F.xxhash64("digest")))
    hits = probed.filter("listed").join(repeated, "digest", "left")
    stays = F.col("group_size").isNull() | (F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    stay = hits.filter(stays)
    once = stay.filter(F.col("group_size").isNull()).select("row.*")
    winners = stay.filter(F.col("group_size").isNotNull()).dropDuplicates(["digest"]).select("row.*")
    return probed.filter(~F.col("listed")).select("row.*").unionByName(once).unionByName(winners)
