"""Near-duplicate detection by a signature-coordinate inverted join.

Every distinct shingle set has a signature of ``COORDINATES`` coordinates. The value of a coordinate is a
pair of MinHash values, so two sets of similarity s agree in it with probability s^2: similar sets in most,
others, which share only frequent shingles, in very few. Sets are posted under each (coordinate, value).
Two sets are linked if their Jaccard similarity is at least ``SIMILARITY``; then they agree in far more than
``MATCHES`` coordinates and ``HALF_MATCHES`` of the MinHash values. So

* skip: values that only one set has are dropped, and with them every set that has fewer than ``MATCHES``
  others, before anything is compared;
* prefix: of the m values that a set shares with others, any partner must be under one of the m - MATCHES + 1
  rarest, so only these posting lists are merged;
* merge: collisions are counted within a list, on whole signatures; sets that have enough of them with a set
  of another component are brought together and confirmed on the full sets.

Sets meet in cells of bounded size, and inside a cell only sets that are not yet in one component are
compared, so a group of copies costs about one comparison each. First every set meets others of one of its
lists; this ties nearly all copies together. Then lists that still hold several components are merged, long
ones as pairs of blocks. Only links leave a cell, never pairs that are not links, and only texts of sets
with enough collisions travel to one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm import bloom
from moodtide.llm.common import map_batches, mix64, slices, texts_of
from moodtide.llm.components import connected_components
from moodtide.session import durable

#: Words of a shingle, and the similarity, in percent, from which sets are linked.
SHINGLE, SIMILARITY = 5, 80
#: Two sets of similarity 0.8 agree in fewer than 7 of 32 coordinates, or in fewer than 35 of the 64 MinHash
#: values, about once in a million times each.
COORDINATES, MATCHES, HALF_MATCHES = 32, 7, 35
#: Bits of a token that hold the value of its coordinate.
_VALUE_BITS = 56
#: Sets of a block; lists with more are cut into blocks, and each pair of blocks is a cell.
BLOCK = 512
_BASE = 0x9E3779B97F4A7C15 | 1
_TEXT_BYTES = 1 << 20


@lru_cache(maxsize=1)
def _powers() -> dict[str, np.ndarray]:
    return {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n``; kept up to a size until the task ends."""
    table = _powers()
    if len(table.get("up", ())) < n:
        size = max(n, _TEXT_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            table[name] = np.multiply.accumulate(powers)
    up, down = table["up"], table["down"]
    if len(up) > 2 * _TEXT_BYTES:
        table.clear()
    return up, down


def _without_tables(function):
    """``function`` over batches; the powers go with its task, as workers stay for other stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _powers().clear()

    return run


_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of UTF-8 texts, A-Z lower-cased, one text after the other, and each text's
    first place and the end."""
    sizes = np.array([len(e) + 1 for e in encoded], np.int64)
    data = _LOWER[np.frombuffer(b" ".join(encoded) + b" ", np.uint8)]
    space = _SPACES[data]
    before = np.concatenate(([True], space[:-1]))
    first = np.flatnonzero(~space & before)
    after = np.flatnonzero(space & ~before)
    up, down = _power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = mix64((sums[after] - sums[first]) * down[first] + (after - first).astype(np.uint64))
    texts = np.concatenate(([0], np.cumsum(sizes)))
    return hashes, np.searchsorted(first, texts)


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes. A text with fewer words than a shingle has
    its whole sequence as one; a text without words has none."""
    encoded, found, at = [t.encode("utf-8", "replace") for t in texts], [], 0
    while at < len(encoded):
        end, total = at, 0
        while end < len(encoded) and (end == at or total + len(encoded[end]) <= _TEXT_BYTES):
            total += len(encoded[end])
            end += 1
        words, starts = word_hashes(encoded[at:end])
        rolled = words.copy()
        for i in range(1, size):
            rolled = mix64(rolled[:-1] * np.uint64(0x2545F4914F6CDD1D) + words[i:])
        for a, b in zip(starts, starts[1:]):
            if b - a >= size:
                found.append(np.unique(rolled[a : b - size + 1]))
            else:
                whole = words[a : min(b, a + 1)].copy()
                for i in range(a + 1, b):
                    whole = mix64(whole * np.uint64(0x2545F4914F6CDD1D) + words[i : i + 1])
                found.append(whole)
        at = end
    return found


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    numbers = np.random.default_rng(20240501).integers(1, 1 << 63, (2, 2 * COORDINATES, 1)).astype(np.uint64)
    return numbers[0] | np.uint64(1), numbers[1]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least 32-bit value of the set under each of the hash functions; two make a coordinate."""
    a, b = _permutations()
    least = np.full(2 * COORDINATES, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(shingles), 4096):
        values = (a * shingles[None, i : i + 4096] + b) >> np.uint64(32)
        np.minimum(least, values.min(axis=1), out=least)
    return least.astype(np.uint32).view(np.int32)


def sketches(
    docs: DataFrame, size: int = SHINGLE, text: str = "text", doc_id: str = "doc_id", extra: tuple[Column, ...] = ()
) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, signature, extra) of each whole text; without shingles, nulls."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets(texts_of(part.column(1)), size)
            digests = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            signatures = [signature(s).tolist() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.list_(pa.int32())), *part.columns[2:],
                ],
                names=["doc_id", "n_shingles", "digest", "signature", *part.schema.names[2:]],
            )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *extra)
    added = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return map_batches(rows, _without_tables(sketch), "doc_id bigint, n_shingles bigint, digest binary, signature array<int>" + added)


def _tokens(signature: str) -> Column:
    """The (coordinate, value) of each coordinate as one long."""

    def token(i: Column) -> Column:
        value = F.xxhash64(F.get(signature, 2 * i), F.get(signature, 2 * i + 1)).bitwiseAND((1 << _VALUE_BITS) - 1)
        return F.shiftleft(i.cast("long"), _VALUE_BITS).bitwiseOR(value)

    return F.transform(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), token)


def _blocks(n: Column) -> Column:
    """How many blocks a list of ``n`` sets is cut into."""
    return F.ceil(n / BLOCK).cast("int")


def _block_of(blocks: str) -> Column:
    return F.pmod(F.hash("nid"), F.col(blocks))


def prefix_postings(nodes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """(token, nid, posted): the lists that must be merged. ``posted`` has a bit for each coordinate under
    which the set is posted."""
    tokens = nodes.select("nid", F.explode(_tokens("signature")).alias("token"))
    shared = durable(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") > 1))
    listed = tokens.join(shared, "token").groupBy("nid").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("found"))
    rarest = F.transform(F.slice("found", 1, F.size("found") - (matches - 1)), lambda s: s["token"])
    kept = listed.filter(F.size("found") >= matches).select("nid", rarest.alias("tokens"))

    def bit(token: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(token, _VALUE_BITS).cast("int"))

    bits = F.aggregate("tokens", F.lit(0).cast("long"), lambda found, t: found.bitwiseOR(bit(t)))
    return durable(kept.select("nid", bits.alias("posted"), F.explode("tokens").alias("token")))


def _texts_of_sets(docs: DataFrame, wanted: DataFrame, size: int, text: str, doc_id: str) -> DataFrame:
    """(digest, text) with a text of each wanted set (digest, rep). A Bloom filter of the texts' ids spares the
    others; texts of other sets that it passes are not asked for later.

    The filter is probed where the sets are made. A second Python function in the stage would have every executor keep
    twice the workers, and later stages run on all of them in turn.
    """
    filled = bloom.build(wanted.select(F.xxhash64("rep").alias("h")), wanted.count())
    shared = docs.sparkSession.sparkContext.broadcast(filled)
    doc_id = F.col(doc_id).cast("bigint")
    rows = docs.select(F.xxhash64(doc_id).alias("h"), F.col(text).cast("string").alias("text"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # rows that repeat an id and a text
        for batch in batches:
            listed = pa.array(bloom.contains(shared.value, batch.column(0).to_numpy()))
            for part in slices(iter((batch.filter(listed),))):
                found = [hashlib.md5(s.tobytes()).digest() for s in shingle_sets(texts_of(part.column(1)), size)]
                new = [i for i, d in enumerate(found) if d not in seen and not seen.add(d)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([found[i] for i in new], pa.binary()), part.column(1).take(pa.array(new, pa.int64()))], names=["digest", "text"]
                )

    return durable(map_batches(rows, _without_tables(digests), "digest binary, text string"))


def links_within(cells: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, similarity: int, text: str, doc_id: str) -> DataFrame:
    """Links (a, b) between sets of one cell that are similar on their full sets.

    ``cells`` has (key, i, j, block, nid, root): a cell is a key and two blocks; if these differ, only sets of
    different blocks are compared. Sets of one root, or tied together by links of the cell, are not compared
    again. The texts travel, as they are smaller than the sets; the cell makes the sets.
    """
    wanted = durable(nodes.join(cells.select("nid").distinct(), "nid", "left_semi").select("nid", "digest", "rep"))
    texts = _texts_of_sets(docs, wanted, size, text, doc_id)
    rows = cells.join(wanted.select("nid", "digest"), "nid").join(texts, "digest").drop("digest")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _runs(batches):
            cell = cell.drop_duplicates("nid")
            a, b = _cell_links(cell, shingle_sets(cell["text"].tolist(), size), similarity)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return durable(map_batches(dealt.select("key", "i", "j", "block", "nid", "root", "text"), _without_tables(confirm), "a bigint, b bigint"))


def _first_cells(postings: DataFrame, nodes: DataFrame, matches: int) -> DataFrame:
    """Every posted set once, in a cell of the first set of one of its lists, which is in all its cells; of
    these, the sets that agree with another one of their cell."""
    first = durable(postings.groupBy("token").agg(F.min("nid").alias("key")))
    chosen = durable(postings.join(first, "token").groupBy("nid").agg(F.min("key").alias("key")))
    counted = chosen.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("nid").alias("low"), F.max("nid").alias("high"))
    several = counted.filter((F.col("low") != F.col("key")) | (F.col("high") != F.col("key")))
    sizes = durable(several.select("key", _blocks(F.col("n")).alias("blocks")))
    members = chosen.filter(F.col("nid") != F.col("key")).join(sizes, "key").withColumn("block", _block_of("blocks"))
    first_sets = sizes.select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("key").alias("nid"))
    both = members.select("key", "block", "nid").unionByName(first_sets)
    cells = both.join(nodes.select("nid", "signature"), "nid").select(
        "key", F.col("block").alias("i"), F.col("block").alias("j"), "block", "nid", F.col("nid").alias("root"),
        F.lit(0).cast("long").alias("posted"), "signature",
    )
    return _merged(cells, matches, once=False)


def _open_cells(postings: DataFrame, nodes: DataFrame, roots: DataFrame, matches: int) -> DataFrame:
    """The cells in which sets of different components agree in ``matches`` coordinates, with these sets only.

    A pair of sets counts in one list: that of the first coordinate in which they agree and under which both
    are posted.
    """
    placed = durable(
        postings.join(roots, F.col("nid") == F.col("node"), "left").select(
            F.col("token").alias("key"), "nid", "posted", F.coalesce("root", "nid").alias("root")
        )
    )
    lists = placed.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")
    ).filter(F.col("low") != F.col("high"))
    lists = durable(lists.select("key", _blocks(F.col("n")).alias("blocks")))
    rows = placed.join(lists, "key").withColumn("block", _block_of("blocks"))
    rows = rows.join(nodes.select("nid", "signature"), "nid")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cells = rows.select("key", "block", "nid", "posted", "root", "signature", other).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "nid", "root",
        "posted", "signature",
    )
    return _merged(cells, matches, once=True)


def _merged(cells: DataFrame, matches: int, once: bool) -> DataFrame:
    """The rows of the cells that agree with another row of theirs; with ``once``, counted in one list only."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _runs(batches):
            found = _agreeing(cell, matches, once)
            if len(found):
                kept = cell.iloc[found][["key", "i", "j", "block", "nid", "root"]]
                yield pa.RecordBatch.from_pandas(kept, preserve_index=False)

    dealt = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return durable(map_batches(dealt, merge, "key bigint, i int, j int, block int, nid bigint, root bigint"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """The rows of one (key, i, j) after the other, from sorted batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        frame = batch.to_pandas()
        key = frame[["key", "i", "j"]].to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(frame)]))
        for start, stop in zip(cuts, cuts[1:]):
            if start == stop:
                continue
            if held and (held[-1][["key", "i", "j"]].iloc[-1].to_numpy() != key[start]).any():
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(frame.iloc[start:stop])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _partners(cell: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of the cell's first block with the rows it may be compared with."""
    block, i, j = cell["block"].to_numpy(), int(cell["i"].iloc[0]), int(cell["j"].iloc[0])
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    for n, at in enumerate(left):
        yield at, right[n + 1 :] if i == j else right


def _agreeing(cell: pd.DataFrame, matches: int, once: bool) -> np.ndarray:
    """The rows that agree with one of another root in enough coordinates. With ``once``, a pair counts in the
    list of the first coordinate in which both agree and are posted."""
    root = cell["root"].to_numpy()
    if (root == root[0]).all():
        return np.zeros(0, np.int64)
    signatures, posted = np.stack(cell["signature"].to_numpy()), cell["posted"].to_numpy().astype(np.uint64)
    coordinate, agree = int(cell["key"].iloc[0]) >> _VALUE_BITS, np.zeros(len(cell), bool)
    bits = np.arange(COORDINATES, dtype=np.uint64)
    for at, others in _partners(cell):
        others = others[root[others] != root[at]]
        equal = signatures[others] == signatures[at]
        enough = equal.sum(axis=1) >= HALF_MATCHES
        others, equal = others[enough], equal[enough].reshape(-1, COORDINATES, 2).all(axis=2)
        enough = equal.sum(axis=1) >= matches
        others, equal = others[enough], equal[enough]
        if len(others):
            if once:
                under_both = (posted[others] & posted[at])[:, None] >> bits & np.uint64(1) != 0
                others = others[(equal & under_both).argmax(axis=1) == coordinate]
            agree[others] = True
            agree[at] |= len(others) > 0
    return np.flatnonzero(agree)


def _bit_rows(sets: list[np.ndarray]) -> np.ndarray:
    """The sets as rows of bits, over the shingles that two or more of them have."""
    sizes = np.array([len(s) for s in sets])
    _, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    dense = np.cumsum(counts > 1) - 1
    shared = counts[place] > 1
    row, bit = np.repeat(np.arange(len(sets)), sizes)[shared], dense[place][shared]
    words = int(dense[-1]) // 64 + 1
    rows = np.zeros((len(sets), words), np.uint64)
    if len(bit):
        at = row * words + bit // 64
        order = np.argsort(at, kind="stable")
        at, value = at[order], (np.uint64(1) << (bit % 64).astype(np.uint64))[order]
        starts = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        rows.ravel()[at[starts]] = np.bitwise_or.reduceat(value, starts)
    return rows


def _cell_links(cell: pd.DataFrame, sets: list[np.ndarray], similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one cell; sets that are tied together already are not compared."""
    nid, tied = cell["nid"].to_numpy(), cell["root"].to_numpy().copy()
    if len(sets) < 2 or (tied == tied[0]).all():
        return nid[:0], nid[:0]
    sizes, rows = np.array([len(s) for s in sets]), _bit_rows(sets)
    found_a, found_b = [], []
    for at, others in _partners(cell):
        smaller, larger = np.minimum(sizes[others], sizes[at]), np.maximum(sizes[others], sizes[at])
        others = others[(tied[others] != tied[at]) & (100 * smaller >= similarity * larger)]
        if not len(others):
            continue
        both = np.bitwise_count(rows[others] & rows[at]).sum(axis=1, dtype=np.int64)
        others = others[100 * both >= similarity * (sizes[others] + sizes[at] - both)]
        if len(others):
            tied[np.isin(tied, tied[others])] = tied[at]
            found_a.append(np.full(len(others), nid[at]))
            found_b.append(nid[others])
    if not found_a:
        return nid[:0], nid[:0]
    return np.concatenate(found_a), np.concatenate(found_b)


def _grouped(
    docs: DataFrame, size: int, similarity: int, text: str, doc_id: str, extra: tuple[Column, ...] = (), measures: tuple[Column, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The sketches, and (digest, rep, measures, root) of each distinct set; sets of one root are near copies."""
    if not 80 <= similarity <= 100:
        raise ValueError("similarity must be between 80 and 100")
    drawn = durable(sketches(docs, size, text, doc_id, extra))
    nodes = durable(
        drawn.filter(F.col("n_shingles") > 0).groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"), *measures
        ).withColumn("nid", F.monotonically_increasing_id())
    )
    postings = prefix_postings(nodes)
    links = links_within(_first_cells(postings, nodes, MATCHES), nodes, docs, size, similarity, text, doc_id)
    cells = _open_cells(postings, nodes, durable(connected_components(links)), MATCHES)
    more = links_within(cells, nodes, docs, size, similarity, text, doc_id)
    roots = durable(connected_components(links.unionByName(more)))
    placed = nodes.join(roots, F.col("nid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "nid"))
    return drawn, placed.drop("n_shingles", "signature", "nid", "node")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, similarity: int = SIMILARITY, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id that links reach), kept.

    Words are separated by ASCII white space and compared with A-Z lower-cased. Null and empty texts and
    texts without words have an empty set, are linked with nothing and are kept. Texts with equal sets are
    linked. Null doc_id: never the smallest, unless a component has no other; its component_id is then null
    and all its rows are kept. Repeated rows are equal sets; rows that repeat the smallest id are all kept.
    An empty table gives no rows. Other columns are ignored. ``similarity`` must be 80 or more, for which
    the number of matches is chosen.
    """
    drawn, placed = _grouped(docs, size, similarity, text, doc_id)
    some = drawn.filter(F.col("n_shingles") > 0)
    smallest = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = durable(placed.join(smallest, "root").select("digest", "component_id"))
    linked = some.join(classes, "digest").select("doc_id", "n_shingles", "component_id")
    alone = drawn.filter(F.col("n_shingles") == 0).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _listed_rows(docs: DataFrame, size: int, similarity: int, text: str, doc_id: str, text_hash: Column) -> DataFrame:
    """(doc_id, text_hash, wins): the rows that near copies of theirs drop, and the ones that stay but are there
    more than once. Rows with one id and one text are told apart by nothing else."""
    no_id, row = F.col("doc_id").isNull(), F.struct("doc_id", "text_hash")
    measures = (
        F.min(F.when(~no_id, row)).alias("first_row"), F.min(F.when(no_id, F.col("text_hash"))).alias("first_without_id"),
        F.count(F.lit(1)).alias("n"),
    )
    drawn, placed = _grouped(docs, size, similarity, text, doc_id, (text_hash,), measures)
    placed = durable(placed)
    groups = placed.groupBy("root").agg(
        F.min("first_row").alias("first_row"), F.min("first_without_id").alias("first_without_id"), F.sum("n").alias("n")
    )
    classes = durable(placed.select("digest", "root").join(groups.filter(F.col("n") > 1), "root").drop("root", "n"))
    wins = F.when(no_id, F.col("text_hash") == F.col("first_without_id")).otherwise(row == F.col("first_row"))
    judged = drawn.filter(F.col("n_shingles") > 0).join(classes, "digest").select("doc_id", "text_hash", wins.alias("wins"))
    counted = judged.groupBy("doc_id", "text_hash").agg(F.first("wins").alias("wins"), F.count(F.lit(1)).alias("n"))
    return durable(counted.filter(~F.col("wins") | (F.col("n") > 1)).drop("n"))


def keep_one_per_group(
    docs: DataFrame, size: int = SHINGLE, similarity: int = SIMILARITY, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row of each group of near copies, with all its columns; texts without words all stay.

    Each row is judged by its own text, so rows of one id may stay and go. The row with the smallest doc_id
    stays; of several with this id, the one whose text has the smallest MD5; of rows with one id and one
    text, any one. Rows without an id are not dropped for one with an id; of those of a group, one stays.

    Rows that a Bloom filter of the listed ones does not pass stay where they are; only possible hits are
    moved, to a join.
    """
    text_hash = F.unhex(F.md5(F.col(text).cast("string").cast("binary"))).alias("text_hash")
    listed = _listed_rows(docs, size, similarity, text, doc_id, text_hash)
    key = F.xxhash64("doc_id", "text_hash")
    filled = bloom.build(listed.select(key.alias("h")), listed.count())
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), text_hash)
    probed = rows.withColumn("listed", bloom.may_contain(rows, filled, key))
    marks = listed.select(F.col("doc_id").alias("listed_id"), F.col("text_hash").alias("listed_hash"), "wins")
    same = F.col("doc_id").eqNullSafe(F.col("listed_id")) & F.col("text_hash").eqNullSafe(F.col("listed_hash"))
    hits = probed.filter("listed").join(marks, same, "left")
    spared = hits.filter(F.col("wins").isNull())
    winners = hits.filter("wins").dropDuplicates(["doc_id", "text_hash"])
    return probed.filter(~F.col("listed")).select("row.*").unionByName(spared.select("row.*")).unionByName(winners.select("row.*"))
