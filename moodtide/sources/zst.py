"""Reader for zstandard line dumps written with a long window.

Spark reads ordinary ``.zst`` text itself. Dumps compressed with a window above the decoder's
default limit need that limit raised, which only the zstandard library offers; this data source
does so on the executors, one task per file, streaming the file in batches. A task may hold a
decoder window of up to 2 GiB, so leave each task that much memory outside the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from moodtide.session import qualified, ship_package
from moodtide.sources.files import arrow_file_system

# Fixed value: the largest window the dumps use.
MAX_WINDOW = 2**31
_BATCH_BYTES = 8 << 20


class ZstFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def _line_blocks(stream) -> Iterator[str]:
    """The decoded text in pieces that end with a line; carriage returns end lines too, as in Spark's reader."""
    rest = b""
    while block := stream.read(_BATCH_BYTES):
        data = rest + block
        cut = data.rfind(b"\n") + 1 or data.rfind(b"\r", 0, -1) + 1
        rest = data[cut:]
        if cut:
            yield data[:cut].decode("utf-8", "replace")
    if rest:
        yield rest.decode("utf-8", "replace")


def _spelled(root: str, path: str) -> str:
    """An Arrow path below ``root`` the way Spark's own readers name files: "file:/x", "hdfs://host/x"."""
    if root.startswith("file:"):
        return "file:" + path
    scheme, rest = root.split("://", 1)
    return f"{scheme}://{rest.split('/', 1)[0] if path.startswith('/') else ''}{path}"


class ZstLinesReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        """One task per ``.zst`` file below the path, in name order."""
        from pyarrow import fs

        filesystem, root = arrow_file_system(self.path)
        info = filesystem.get_file_info(root)
        found = [info] if info.is_file else filesystem.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted(f.path for f in found if f.is_file and f.path.endswith(".zst"))
        return [ZstFile(_spelled(self.path, p)) for p in files]

    def read(self, partition: ZstFile):
        """Record batches of (file, block, line number, line). Blocks of decoded text are split as a whole."""
        import pyarrow as pa
        import pyarrow.compute as pc
        import zstandard

        if partition is None:  # no file at the path: Spark still runs one empty task
            return
        filesystem, path = arrow_file_system(partition.path)
        with filesystem.open_input_stream(path, compression=None) as raw:
            decoder = zstandard.ZstdDecompressor(max_window_size=MAX_WINDOW)
            start = 0
            for text in _line_blocks(decoder.stream_reader(raw, read_across_frames=True)):
                whole = pa.array([text.replace("\r\n", "\n").replace("\r", "\n").removesuffix("\n")], pa.large_string())
                values = pc.split_pattern(whole, "\n").flatten().cast(pa.string())
                n = len(values)
                rows = pa.array(range(start, start + n), pa.int64())
                file, block = pa.array([partition.path] * n, pa.string()), pa.array([0] * n, pa.int64())
                yield pa.RecordBatch.from_arrays([file, block, rows, values], names=["src_file", "src_block", "src_row", "value"])
                start += n


class ZstLines(DataSource):
    @classmethod
    def name(cls):
        return "zst_lines"

    def schema(self):
        return "src_file string, src_block bigint, src_row bigint, value string"

    def reader(self, schema):
        return ZstLinesReader(self.options["path"])


def scan_zst(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the ``.zst`` files at a path or URI, whatever window they were written with, with the same
    file-order columns as ``scan_lines``."""
    ship_package(spark)
    spark.dataSource.register(ZstLines)
    return spark.read.format("zst_lines").load(qualified(spark, path))
