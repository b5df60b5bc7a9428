"""Token-id files: one concatenated id array per shard, with Elias-Fano coded document boundaries.

A shard is two files. ``<name>.ids`` has the ids of its documents one after the other, as little-endian
unsigned integers of 2 or 4 bytes. ``<name>.idx`` has the documents' ids and ends. The ends, a rising
sequence, are stored as Elias-Fano code: about 2 + log2(ids per document) bits each instead of 64, with a
sample of the positions of the set bits so that any end is found without decoding the ones before it.
The manifest, a table written by Spark after the shards, names the files that count and the first id of
each, so a shard that was written twice, or by an executor that was lost, is never read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodtide.llm.bpe import PATTERN, Vocabulary, default_vocabulary, encoder
from moodtide.llm.common import map_batches, slices, texts_of
from moodtide.session import qualified
from moodtide.sources.files import arrow_file_system

END_OF_DOCUMENT = 2
_MAGIC = b"TOKIDX01"
_HEADER = struct.Struct("<8sBBxxxxxxQQQQQ")  # magic, id bytes, low bits, documents, ids, lengths of low, high, samples
_SAMPLE = 256
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class EliasFano:
    """A non-decreasing sequence of non-negative integers in near-minimal space, with random access."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        lows = (values[:, None] >> np.arange(low_bits)) & 1 if n else np.zeros((0, low_bits))
        ones = (values >> low_bits) + np.arange(n)
        bits = np.zeros((int(ones[-1]) if n else 0) + 1, np.uint8)
        bits[ones] = 1
        pack = lambda x: np.packbits(x.astype(np.uint8).ravel(), bitorder="little")
        return cls(n, low_bits, pack(lows), pack(bits), ones[::_SAMPLE].astype(np.uint64))

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.int64)
        start, stop = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start]
        return bits.reshape(-1, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """Value number ``i``: the sample before it, a count of set bits by bytes, then one byte."""
        at = int(self.samples[i // _SAMPLE])
        skip = i % _SAMPLE  # set bits to pass after the one at `at`
        byte, block = at // 8, 64
        first = int(self.high[byte]) & 0xFF << at % 8 & 0xFF
        left = skip + 1
        if _ONES[first] < left:
            left -= int(_ONES[first])
            byte += 1
            while True:
                counts = np.cumsum(_ONES[self.high[byte : byte + block]])
                if counts[-1] >= left:
                    step = int(np.searchsorted(counts, left))
                    left -= int(counts[step - 1]) if step else 0
                    byte += step
                    break
                left -= int(counts[-1])
                byte += block
            first = int(self.high[byte])
        for _ in range(left - 1):
            first &= first - 1
        position = byte * 8 + ((first & -first).bit_length() - 1)
        return (position - i) << self.low_bits | int(self._low(i, i + 1)[0])

    def values(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last`` - 1, decoding only the bits that hold them."""
        if last <= first:
            return np.zeros(0, np.int64)
        sample = first // _SAMPLE
        start = int(self.samples[sample]) // 8
        after = -(-last // _SAMPLE)
        stop = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[start:stop], bitorder="little")) + start * 8
        ones = ones[ones >= int(self.samples[sample])][first - sample * _SAMPLE :][: last - first]
        return (ones - np.arange(first, last)) << self.low_bits | self._low(first, last)

    def nbytes(self) -> int:
        return self.low.nbytes + self.high.nbytes + self.samples.nbytes


def write_index(out, id_bytes: int, n_ids: int, doc_ids: list[int | None], ends: np.ndarray) -> None:
    code = EliasFano.encode(ends)
    parts = (code.low.tobytes(), code.high.tobytes(), code.samples.astype("<u8").tobytes())
    out.write(_HEADER.pack(_MAGIC, id_bytes, code.low_bits, code.count, n_ids, *map(len, parts)))
    for part in parts:
        out.write(part)
    missing = np.array([d is None for d in doc_ids], bool)
    out.write(np.packbits(missing, bitorder="little").tobytes())
    out.write(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())


def read_index(data: bytes) -> tuple[int, int, EliasFano, list[int | None]]:
    """(bytes of an id, number of ids, ends, document ids)."""
    magic, id_bytes, low_bits, count, n_ids, *sizes = _HEADER.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a token index")
    at, parts = _HEADER.size, []
    for size in sizes:
        parts.append(np.frombuffer(data, np.uint8, size, at))
        at += size
    code = EliasFano(count, low_bits, parts[0], parts[1], parts[2].view("<u8") if sizes[2] else np.zeros(0, np.uint64))
    bitmap = -(-count // 8)
    missing = np.unpackbits(np.frombuffer(data, np.uint8, bitmap, at), bitorder="little")[:count]
    doc_ids = np.frombuffer(data, "<i8", count, at + bitmap)
    return id_bytes, n_ids, code, [None if m else int(d) for d, m in zip(doc_ids, missing)]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """Rank-table encoder with the ids of the vocabulary file: the same tokens, several times as fast."""
    import tiktoken

    vocabulary = Vocabulary(path)
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=vocabulary.ids, special_tokens=vocabulary.special)


def encode_ids(text: str, path: str) -> np.ndarray:
    """The ids of a whole text. The rank-table encoder's pattern search gives up on runs of about a million
    white-space characters; such texts go through this package's own encoder, which gives the same ids."""
    try:
        return _tokenizer(path).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.frombuffer(encoder(path).encode_batch([text])[0], np.int32)


def _id_bytes(path: str) -> int:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    top = max([*content["model"]["vocab"].values(), *(t["id"] for t in content["added_tokens"])])
    return 2 if top < 1 << 16 else 4


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str | None = None, text: str = "text", doc_id: str = "doc_id",
    shards: int | None = None, end_id: int = END_OF_DOCUMENT,
) -> DataFrame:
    """Encode whole texts, end each with ``end_id`` and write them to ``path`` in ascending doc_id order.

    Returns the manifest: shard, file, n_docs, n_ids, start (ids of all shards before it). ``shards`` is the
    number of range partitions; by default that of the session's shuffles.

    Null text: the end id alone. Null doc_id: first. Rows of equal ids stand next to each other, by a hash
    of their text; a range may be cut between them, so a hot id is spread. An empty table gives no shards.
    Other columns are ignored. Memory of a task: one batch, and 8 bytes and the key for each document.
    """
    spark = docs.sparkSession
    root = qualified(spark, path)
    source = vocabulary or default_vocabulary()

    rows_written = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _id_bytes(source)
        kind = "<u2" if width == 2 else "<u4"
        system, folder = arrow_file_system(root)
        name, out = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", None
        keys: list[int | None] = []
        sizes: list[int] = []
        for part in slices(batches):
            if out is None:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(f"{folder}/{name}.ids", compression=None, buffer_size=1 << 20)
            found = [encode_ids(t, source) for t in texts_of(part.column(1))]
            ids = np.concatenate([x for f in found for x in (f, (end_id,))]).astype(kind)
            out.write(ids.tobytes())
            sizes += [len(f) + 1 for f in found]
            keys += part.column(0).to_pylist()
        if out is not None:
            out.close()
            ends = np.cumsum(sizes, dtype=np.int64)
            with system.open_output_stream(f"{folder}/{name}.idx", compression=None) as index:
                write_index(index, width, int(ends[-1]), keys, ends)
            row = {"shard": TaskContext.get().partitionId(), "file": name, "n_docs": len(keys), "n_ids": int(ends[-1])}
            yield pa.RecordBatch.from_pylist([row], rows_written)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = rows.select("doc_id", "text", order[1].alias("t1"), order[2].alias("t2"))
    ranges = [order[0], "t1", "t2"]
    dealt = keyed.repartitionByRange(shards, *ranges) if shards else keyed.repartitionByRange(*ranges)
    in_order = dealt.sortWithinPartitions(*ranges).select("doc_id", "text")
    written = map_batches(in_order, write, "shard int, file string, n_docs bigint, n_ids bigint")
    written.write.parquet(f"{root}/written")
    listed = spark.read.parquet(f"{root}/written")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    listed.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(f"{root}/manifest")
    return read_manifest(spark, root)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{qualified(spark, path)}/manifest")


def read_token_files(spark: SparkSession, path: str, docs_at_a_time: int = 4096) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers, the end id included). One task per shard; ids are read in pieces."""
    root = qualified(spark, path)
    manifest = read_manifest(spark, root)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = arrow_file_system(root)
        for batch in batches:
            for shard in batch.to_pylist():
                with system.open_input_stream(f"{folder}/{shard['file']}.idx", compression=None) as file:
                    width, _, ends, keys = read_index(file.read())
                kind = "<u2" if width == 2 else "<u4"
                with system.open_input_file(f"{folder}/{shard['file']}.ids") as file:
                    for first in range(0, ends.count, docs_at_a_time):
                        last = min(ends.count, first + docs_at_a_time)
                        stops = ends.values(first, last)
                        begin = ends.select(first - 1) if first else 0
                        starts = np.concatenate(([begin], stops[:-1]))
                        file.seek(begin * width)
                        ids = np.frombuffer(file.read(int(stops[-1] - begin) * width), kind).astype("<u4")
                        sums = [zlib.crc32(ids[a - begin : b - begin]) for a, b in zip(starts, stops)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys[first:last], pa.int64()), pa.array(starts + shard["start"], pa.int64()),
                                pa.array(stops - starts, pa.int64()), pa.array(sums, pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    dealt = manifest.repartitionById(max(1, manifest.count()), F.col("shard"))
    return map_batches(dealt, read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
