"""A ``.zst`` line dump with several frames read by several tasks.

Frames are decoded independently, and where they end can be read off their block headers without decoding
anything. The index of a file is one such walk; a run of neighbouring frames is one task. A line belongs to the
run that it begins in; as in Spark's own split text files, each run but the first leaves its first line to the
run before, which reads on into the next frames for it. A dump of one frame stays one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.session import durable, ship_package
from moodtide.sources.files import arrow_file_system
from moodtide.sources.zst import MAX_WINDOW

#: Compressed bytes of a run of frames.
RUN_BYTES = 64 << 20
_READ_BYTES = 4 << 20
# Fixed values of the format: a skippable frame's first four bytes, and the longest frame header.
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_LONGEST_HEADER = 18
_TERMINATOR = re.compile(rb"\r\n|\r|\n")


class _Window:
    """Bytes of a file by offset, read in long pieces."""

    def __init__(self, file):
        self.file, self.start, self.data, self.size = file, 0, b"", file.size()

    def at(self, offset: int, n: int) -> bytes:
        if not self.start <= offset <= offset + n <= self.start + len(self.data):
            self.start, self.data = offset, self.file.read_at(min(_READ_BYTES, self.size - offset), offset)
        return self.data[offset - self.start : offset - self.start + n]


def frame_ends(file) -> Iterator[tuple[int, int]]:
    """(start, end) of each frame of an open file. A broken or unfinished frame takes the rest of the file."""
    import zstandard

    window, start = _Window(file), 0
    while start < window.size:
        head = window.at(start, min(_LONGEST_HEADER, window.size - start))
        if len(head) >= 8 and int.from_bytes(head[:4], "little") in _SKIPPABLE:
            end = start + 8 + int.from_bytes(head[4:8], "little")
        else:
            try:
                end = start + zstandard.frame_header_size(head)
                checksum = zstandard.get_frame_parameters(head).has_checksum
            except zstandard.ZstdError:
                yield start, window.size
                return
            last = False
            while not last and end + 3 <= window.size:
                block = int.from_bytes(window.at(end, 3), "little")
                last, kind, length = bool(block & 1), block >> 1 & 3, block >> 3
                end += 3 + (1 if kind == 1 else length)  # a repeated byte is stored once
            end = end + 4 * checksum if last else window.size
        end = min(end, window.size)
        yield start, end
        start = end


def _index(batches):
    import pyarrow as pa

    for batch in batches:
        for path in batch.column("path").to_pylist():
            filesystem, name = arrow_file_system(path)
            with filesystem.open_input_file(name) as file:
                rows = [{"path": path, "start": start, "end": end} for start, end in frame_ends(file)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows)


def frame_index(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, start, end) of every frame of the ``.zst`` files. Reads the files once, a task each, and decodes
    nothing; write the table where the dumps are to be read more than once."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").option("recursiveFileLookup", True)
    found = durable(files.load(path).select("path"))
    return found.repartition(max(1, found.count())).mapInArrow(_index, "path string, start bigint, end bigint")


def frame_runs(index: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(path, start, end) of runs of neighbouring frames: a new run begins with the first frame that begins in
    the next ``run_bytes`` of its file."""
    run = F.floor(F.col("start") / run_bytes)
    return index.groupBy("path", run.alias("run")).agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


class _Bounded:
    """A file's bytes between two offsets as a stream."""

    def __init__(self, file, start: int, end: int):
        self.file, self.place, self.end = file, start, end

    def read(self, n: int = -1) -> bytes:
        n = self.end - self.place if n < 0 else min(n, self.end - self.place)
        data = self.file.read_at(n, self.place) if n else b""
        self.place += len(data)
        return data


def _decoded(file, start: int, end: int) -> Iterator[bytes]:
    import zstandard

    if start < end:
        decoder = zstandard.ZstdDecompressor(max_window_size=MAX_WINDOW)
        stream = decoder.stream_reader(_Bounded(file, start, end), read_across_frames=True)
        while block := stream.read(_READ_BYTES):
            yield block


def run_text(own: Iterator[bytes], after: Iterator[bytes], first: bool) -> Iterator[bytes]:
    """Pieces of whole lines: those that begin in ``own``, or just behind it, the first line left out unless ``first``.

    ``after`` is what follows the run; only the end of the last line is read from it.
    """
    rest = b""
    if not first:
        for block in own:
            # of a line's end at the end of a block, the second half may be still to come
            rest = rest[-1:] + block
            found = _TERMINATOR.search(rest)
            if found and (found.end() < len(rest) or found[0] != b"\r"):
                rest = rest[found.end() :]
                break
        else:
            following = next(after, b"")
            if not rest.endswith(b"\r") or following.startswith(b"\n"):
                return
            own, after, rest = iter(()), chain([following], after), b""
    for block in own:
        rest += block
        cut = rest.rfind(b"\n") + 1 or rest.rfind(b"\r", 0, -1) + 1
        if cut:
            yield rest[:cut]
            rest = rest[cut:]
    pieces = [rest]
    for block in after:
        found = _TERMINATOR.search(block)
        pieces.append(block[: found.end()] if found else block)
        if found:
            break
    if any(pieces):
        yield b"".join(pieces)


def _lines(batches):
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        for row in batch.to_pylist():
            filesystem, name = arrow_file_system(row["path"])
            with filesystem.open_input_file(name) as file:
                own, after = _decoded(file, row["start"], row["end"]), _decoded(file, row["end"], file.size())
                number = 0
                for piece in run_text(own, after, row["start"] == 0):
                    text = piece.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n").removesuffix("\n")
                    values = pc.split_pattern(pa.array([text], pa.large_string()), "\n").flatten().cast(pa.string())
                    n = len(values)
                    columns = [
                        pa.array([row["path"]] * n, pa.string()), pa.array([row["start"]] * n, pa.int64()),
                        pa.array(range(number, number + n), pa.int64()), values,
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["src_file", "src_block", "src_row", "value"])
                    number += n


def scan_zst_frames(
    spark: SparkSession, path: str | list[str] | None = None, index: DataFrame | None = None, run_bytes: int = RUN_BYTES
) -> DataFrame:
    """``scan_zst`` with a task per run of frames: the same lines, with ``src_block`` the run's first byte.

    Give the path, or a stored ``frame_index``. Files without a byte have no lines.
    """
    if index is None:
        index = durable(frame_index(spark, path))
    else:
        ship_package(spark)
    runs = durable(frame_runs(index, run_bytes))
    return runs.repartition(max(1, runs.count())).mapInArrow(
        _lines, "src_file string, src_block bigint, src_row bigint, value string"
    )
