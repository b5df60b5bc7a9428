"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots, once and for all: a record's slot depends on nothing but the
record and the number of slots. Bytes are summed per slot, and a table says which shard holds which slot.
That table is all that balancing looks at and all that rebalancing edits: it is stored in versions, and a new
version moves only the slots that a shard has too many of. Sums, map and edits have one row per slot.

Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodtide.session import durable, numbered, scratch_path

SLOTS, SHARDS = 4096, 24
#: Bytes of a record beside its text.
RECORD_BYTES = 8
#: Shares of a shard's fair load that it may hold before slots are moved off it.
SLACK = 0.01
_PLACE_DIGITS = 15
_KEY = ("doc_id", "size", "text_crc32")


def _measured(docs: DataFrame, text: str, doc_id: str, *payload: Column) -> DataFrame:
    content = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(content) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"), *payload,
    )


def _same(left: str, right: str) -> Column:
    found = F.lit(True)
    for name in _KEY:
        found = found & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return found


def repeated_records(rows: DataFrame) -> DataFrame:
    """The keys (doc_id, size, text_crc32) of records that are there more than once, written."""
    return durable(rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))


def _told_apart(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Adds ``copy``: 0, 1, ... among equal records, so that even one record that makes up a third of a table
    is dealt over all slots. Copies are counted within the task that read them and the tasks' counts are added
    up, so no window holds more rows than a task has read. Which of equal records gets which number does not
    matter."""
    alone = rows.alias("r").join(repeated.alias("k"), _same("r", "k"), "left_anti").withColumn("copy", F.lit(0).cast("long"))
    several = durable(
        rows.alias("r").join(repeated.alias("k"), _same("r", "k"), "left_semi").withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_task", F.shiftright("_at", 33))
    counts = several.groupBy(*_KEY, "_task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*_KEY).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = durable(counts.select(*_KEY, "_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first")))
    within = F.row_number().over(Window.partitionBy(*_KEY, "_task").orderBy("_at")) - 1
    here = several.withColumn("_within", within)
    joined = here.alias("r").join(firsts.alias("k"), _same("r", "k") & (F.col("r._task") == F.col("k._task")))
    return alone.unionByName(joined.select("r.*", (F.col("_within") + F.col("_first")).alias("copy")).drop("_at", "_task", "_within"))


def place() -> Column:
    """The fixed place of a record in [0, 2^60): the first digits of the MD5 of its id, its text's checksum and
    its number among equal records. A null id counts as empty text."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string"), F.col("copy").cast("string"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, _PLACE_DIGITS), 16, 10).cast("long")


def _slot_of(slots: int) -> Column:
    return F.pmod("place", F.lit(slots)).cast("int")


def _dealt(records: DataFrame, slots: int) -> DataFrame:
    return _told_apart(records, repeated_records(records)).withColumn("place", place()).withColumn("virtual_slot", _slot_of(slots))


def records_of(docs: DataFrame, slots: int = SLOTS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, copy, place, virtual_slot) of every row, written."""
    return durable(_dealt(durable(_measured(docs, text, doc_id)), slots))


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes) of every slot, empty ones included; reduced on the map side, then written."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return durable(every.join(sums, "virtual_slot", "left").select("virtual_slot", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")))


def _deal(slots: DataFrame, loads: Column) -> DataFrame:
    """(virtual_slot, shard): slots, the largest first, each to the shard with the least load so far, from
    ``loads`` on; ties go to the lower number. ``slots`` has at most as many rows as there are slots."""
    item = F.struct((-F.col("bytes")).alias("minus"), "virtual_slot")
    ordered = slots.agg(F.sort_array(F.collect_list(item)).alias("items"))

    def least(loads: Column) -> Column:
        return F.array_position(loads, F.array_min(loads)).cast("int") - 1

    def give(state: Column, item: Column) -> Column:
        to = least(state["loads"])
        grown = F.transform(state["loads"], lambda load, i: F.when(i == to, load - item["minus"]).otherwise(load))
        return F.struct(grown.alias("loads"), F.array_append(state["shards"], to).alias("shards"))

    start = F.struct("loads", F.array().cast("array<int>").alias("shards"))
    dealt = ordered.select("items", loads.alias("loads")).select("items", F.aggregate("items", start, give)["shards"].alias("shards"))
    return dealt.select(F.inline(F.arrays_zip(F.transform("items", lambda i: i["virtual_slot"]).alias("virtual_slot"), "shards"))).select(
        "virtual_slot", F.col("shards").alias("shard")
    )


def balanced(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(virtual_slot, shard): a first map, of near equal bytes."""
    return durable(_deal(sizes, F.array_repeat(F.lit(0).cast("long"), shards)))


def edited(current: DataFrame, sizes: DataFrame, shards: int, slack: float = SLACK) -> DataFrame:
    """(virtual_slot, shard): ``current`` with slots moved off shards that hold more than their fair load and
    ``slack``, and off shards that are no longer there. All other slots stay where they are; those moved go,
    the largest first, to the shard with the least load, which is mostly a new one."""
    placed = current.join(sizes, "virtual_slot").withColumn("total", F.sum("bytes").over(Window.partitionBy()))
    upto = F.sum("bytes").over(Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, 0))
    stays = (F.col("shard") < shards) & (upto <= F.col("total") * ((1.0 + slack) / shards))
    judged = durable(placed.withColumn("stays", stays))
    kept = judged.filter("stays").groupBy("shard").agg(F.sum("bytes").alias("load"))
    every = judged.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(kept, "shard", "left")
    load = F.struct("shard", F.coalesce("load", F.lit(0)).cast("long").alias("load"))
    loads = every.agg(F.transform(F.sort_array(F.collect_list(load)), lambda s: s["load"]).alias("loads")).scalar()
    moved = _deal(judged.filter(~F.col("stays")), loads)
    return durable(judged.filter("stays").select("virtual_slot", "shard").unionByName(moved))


class SlotMap:
    """The stored versions of a slot-to-shard map, one folder each below ``path``. A version is written once
    and never changed, so what was placed by it can be found by it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        """Numbers of the complete versions, in order."""
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(root):
            return []
        folders = [f.getPath() for f in system.listStatus(root) if f.getPath().getName().startswith("version=")]
        done = [f for f in folders if system.exists(f.suffix("/_SUCCESS"))]
        return sorted(int(f.getName().removeprefix("version=")) for f in done)

    def read(self, version: int | None = None) -> DataFrame:
        """(virtual_slot, shard) of a version, the last if none is named."""
        known = self.versions()
        if version is None and not known:
            raise ValueError(f"no version of a slot map in {self.path}")
        return self.spark.read.schema("virtual_slot int, shard int").parquet(f"{self.path}/version={known[-1] if version is None else version}")

    def add(self, mapping: DataFrame) -> int:
        """Store the next version; of two that are added at a time, one fails."""
        version = max(self.versions(), default=0) + 1
        mapping.select("virtual_slot", "shard").coalesce(1).write.parquet(f"{self.path}/version={version}")
        return version

    def rebalance(self, sizes: DataFrame, shards: int, slack: float = SLACK) -> int:
        """Store an edit of the last version, for the bytes that slots have now and a number of shards."""
        return self.add(edited(self.read(), sizes, shards, slack))


def new_map(spark: SparkSession) -> SlotMap:
    """A map without versions in the application's scratch folder."""
    return SlotMap(spark, scratch_path(spark, "slot-map"))


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, slot_map: SlotMap | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes of the text and 8), text_crc32, virtual_slot, shard, and
    slot, its number in the shard, without gaps from 0.

    With a ``slot_map`` that has versions its last one holds; otherwise the slots are dealt to ``shards`` shards
    of near equal bytes and the map is stored as the first version.

    Null text: no bytes. Null ids, rows of one id and rows that are there many times are different records and
    are dealt over the slots by their text and their number among equal ones. A very long text is one record;
    a shard is never smaller than its largest record. The same rows give the same shards and numbers however
    they are partitioned. An empty table gives no rows. Other columns are ignored.
    """
    slot_map = slot_map or new_map(docs.sparkSession)
    records = records_of(docs, slots, text, doc_id)
    if not slot_map.versions():
        slot_map.add(balanced(slot_bytes(records, slots), shards))
    placed = records.join(slot_map.read(), "virtual_slot")
    rows = numbered(placed.orderBy("shard", "place", "doc_id", "text_crc32", "copy"), "n")
    firsts = durable(rows.groupBy("shard").agg(F.min("n").alias("first")))
    return rows.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("n") - F.col("first")).alias("slot")
    )


def write_shards(
    docs: DataFrame, path: str, slot_map: SlotMap, slots: int = SLOTS, files: int = 1, text: str = "text", doc_id: str = "doc_id"
) -> None:
    """Write whole documents by the last version of ``slot_map``: a folder ``shard=N`` for each shard with rows,
    of up to ``files`` files, whose rows hold the document's columns in a struct ``document`` and its
    ``virtual_slot``. Rows are handled as by ``shard_documents``; columns may have any names.

    A shard's rows are dealt over its files by their place, so no task holds more than one file's share.
    """
    rows = _dealt(_measured(docs, text, doc_id, F.struct(*docs.columns).alias("document")), slots)
    placed = rows.join(slot_map.read(), "virtual_slot").withColumn("_file", F.shiftright("place", 20) % files)
    placed.repartition("shard", "_file").select("shard", "virtual_slot", "document").write.partitionBy("shard").parquet(path)
