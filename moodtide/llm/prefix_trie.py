"""The trie of shared conversation prefixes, measured by the Euler-tour technique.

A node is a distinct sequence of first turns; its key is the combination of the hashes of (place, turn), so a
turn's key follows from running bit operations within a conversation and no text travels. Every node has an
enter and an exit arc. The arc after each one follows from first children and next siblings alone, so the tour
around the whole trie is a linked list that no task ever holds. It is ranked distributedly (``list_rank``); what
lies between a node's two arcs is its subtree, so subtree totals are differences of the sums at the arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.llm import list_rank
from moodtide.llm.common import map_batches
from moodtide.session import durable, numbered

#: Conversations of a block share the first turns of the block's first conversation, fewer than ``HEADS`` of them.
BLOCK, HEADS = 100, 6
_KEY = ("depth", "k1", "k2")
_NO_IDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_hash, n_chars) of every turn, written; ``pos`` counts from 0 in order of turn, nulls
    first, and of the hash within a turn. Null role and text count as empty, n_chars is the text's code points.
    Rows without a conv_id belong to no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), role, text).cast("binary"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_hash")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.unhex(content).alias("turn_hash"), F.char_length(text).cast("long").alias("n_chars")
    )
    return durable(rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "turn_hash", "n_chars"))


def rebuild(turns: DataFrame, block: int = BLOCK, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv_id, part, pos, turn_hash, n_chars), in order of part and pos, and all conv_ids.

    Conversation c has the first h turns of conversation c - c % block, h = CRC-32 of c modulo ``heads``, and
    then its own after its first h. A block's head is a few rows, each of which goes to at most ``block``
    conversations."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")
    convs = durable(turns.select("conv_id").distinct())
    asked = convs.select("conv_id", h, (F.col("conv_id") - F.col("conv_id") % block).alias("head"))
    first = turns.filter(F.col("pos") < heads).withColumnRenamed("conv_id", "head")
    shared = asked.join(first, "head").filter(F.col("pos") < F.col("h")).select("conv_id", F.lit(0).alias("part"), "pos", "turn_hash", "n_chars")
    own = turns.filter(F.col("pos") >= h).select("conv_id", F.lit(1).alias("part"), "pos", "turn_hash", "n_chars")
    return shared.unionByName(own), convs


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, n_chars, is_end), written: the key of each prefix that is not empty and of
    the prefix before it. Keys are 128 bits; the empty prefix has (0, 0)."""
    order = Window.partitionBy("conv_id").orderBy("part", "pos")
    counted = rebuilt.select(
        "conv_id", "part", "pos", "turn_hash", "n_chars", F.row_number().over(order).cast("long").alias("depth"),
        F.lead("pos").over(order).isNull().alias("is_end"),
    )
    own = [F.xxhash64(F.lit(salt), "depth", "turn_hash").alias(f"h{salt}") for salt in (1, 2)]
    running = [F.bit_xor(f"h{salt}").over(order).alias(f"k{salt}") for salt in (1, 2)]
    before = [F.col(f"k{salt}").bitwiseXOR(F.col(f"h{salt}")).alias(f"p{salt}") for salt in (1, 2)]
    keyed = counted.select("conv_id", "part", "pos", "n_chars", "depth", "is_end", *own).select("*", *running)
    return durable(keyed.select("conv_id", "depth", "k1", "k2", *before, "n_chars", "is_end"))


def trie_nodes(found: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node, written: nid, depth, k1, k2, p1, p2, conv_id (smallest member), n_convs, n_chars. Nodes of
    one parent are numbered one after the other in order of conv_id."""
    nodes = found.groupBy(*_KEY, "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("n_chars").alias("n_chars")
    )
    none = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        none.alias("depth"), none.alias("k1"), none.alias("k2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
        "conv_id", "n_convs", none.alias("n_chars"),
    )
    every = nodes.unionByName(root)
    return durable(numbered(every.orderBy("p1", "p2", "depth", "conv_id"), "nid"))


def _family(nodes: DataFrame) -> DataFrame:
    """The nodes with parent, parent_conv_id, first_child, n_children and sibling (the next one), written."""
    children = nodes.filter(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.min("nid").alias("first_child"), F.count(F.lit(1)).alias("n_children")
    )
    parents = durable(nodes.join(children, list(_KEY), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    following = nodes.filter(F.col("depth") > 0).select((F.col("nid") - 1).alias("nid"), *[F.col(c).alias(f"next_{c}") for c in ("depth", "p1", "p2")])
    same = F.col("next_depth").eqNullSafe(F.col("depth")) & F.col("next_p1").eqNullSafe(F.col("p1")) & F.col("next_p2").eqNullSafe(F.col("p2"))
    with_sibling = parents.join(following, "nid", "left").withColumn("sibling", F.when(same, F.col("nid") + 1))
    above = parents.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("nid").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return durable(with_sibling.drop("next_depth", "next_p1", "next_p2").join(above, ["depth", "p1", "p2"], "left"))


def euler_tour(family: DataFrame) -> DataFrame:
    """(id, next, leaves, saved), written: the enter arc of node n is 2n, its exit arc 2n + 1. A node enters its
    first child, or leaves at once; after it comes its next sibling, or its parent's exit. Weights stand on the
    enter arcs."""
    enter, leave = 2 * F.col("nid"), 2 * F.col("nid") + 1
    saved = (F.col("n_convs") - 1) * F.col("n_chars")
    arcs = F.array(
        F.struct(
            enter.alias("id"), F.coalesce(2 * F.col("first_child"), leave).alias("next"),
            F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), saved.cast("long").alias("saved"),
        ),
        F.struct(
            leave.alias("id"), F.coalesce(2 * F.col("sibling"), 2 * F.col("parent") + 1).alias("next"),
            F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"),
        ),
    )
    return durable(family.select(F.inline(arcs)))


def subtree_totals(tour: DataFrame, count: int, **ranking) -> DataFrame:
    """(nid, n_leaves, saved_tokens): what lies between the two arcs of each node of a tour of ``count`` arcs."""
    sums = list_rank.suffix_sums(tour, count, ("leaves", "saved"), **ranking)
    entering = F.col("id").bitwiseAND(1) == 0

    def between(name: str) -> Column:
        return F.sum(F.when(entering, F.col(name)).otherwise(-F.col(name)))

    return sums.groupBy(F.shiftright("id", 1).alias("nid")).agg(between("leaves").alias("n_leaves"), between("saved").alias("saved_tokens"))


def end_digests(found: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of nodes where conversations end: SHA-256 of their ids, ascending, joined by
    commas. The ids of a node stream through a task in order and are not held."""
    ended = found.filter("is_end")
    turnless = convs.join(ended, "conv_id", "left_anti")
    none = F.lit(0).cast("long")
    ends = ended.select(*_KEY, "conv_id").unionByName(turnless.select(none.alias("depth"), none.alias("k1"), none.alias("k2"), "conv_id"))
    dealt = ends.repartition(*_KEY).sortWithinPartitions(*_KEY, "conv_id")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running, done = None, None, []
        for batch in batches:
            for *at, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if at != key:
                    if running is not None:
                        done.append((*key, running.hexdigest()))
                    key, running = at, hashlib.sha256(str(conv).encode())
                else:
                    running.update(f",{conv}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*_KEY, "ends_sha256"])
                done = []
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, running.hexdigest())], names=[*_KEY, "ends_sha256"])

    return map_batches(dealt, digest, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def prefix_trie(rebuilt: DataFrame, convs: DataFrame, **ranking) -> DataFrame:
    """One row per node of the trie of conversations: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rebuilt`` has (conv_id, part, pos, turn_hash, n_chars), the turns in order of part and pos; ``convs`` has all
    conv_ids, each once, so that those without turns end at the root. Very many copies of a conversation, or
    very many children of a node, are counted and numbered across tasks; only where conversations end do their
    ids pass one task, in order. No conversations, no rows.
    """
    found = prefixes(rebuilt)
    nodes = trie_nodes(found, convs)
    family = _family(nodes)
    totals = subtree_totals(euler_tour(family), 2 * family.count(), **ranking)
    digests = end_digests(found, convs)
    joined = family.join(totals, "nid").join(digests, list(_KEY), "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NO_IDS)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, **ranking) -> DataFrame:
    """The trie of the conversations of a table (conv_id, turn, role, text), rebuilt with shared first turns.

    Turns of one number stand in the order of their hash; repeated rows are turns of their own. Null turn comes
    first, null role and text are empty, rows without a conv_id are in no conversation. Texts are hashed where
    they are read, whole. An empty table gives no rows; other columns are ignored.
    """
    rebuilt, convs = rebuild(ordered_turns(conversations))
    return prefix_trie(rebuilt, convs, **ranking)
