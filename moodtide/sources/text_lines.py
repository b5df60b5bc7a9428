"""JSON-lines text: discovery, plain and compressed scans, blank handling, file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.functions.text import strip_whitespace

# Fixed value: file names taken as line dumps.
DUMP_GLOB = "*.{zst,jsonl,ndjson,json}"
PLAIN_GLOB = "*.{jsonl,ndjson,json}"


def with_file_order(lines: DataFrame) -> DataFrame:
    """Adds file, block and a number increasing within the block, so rows can be put back into
    their original order however the scan was split. Call it directly on a file scan."""
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_row"),
    )


def scan_lines(
    spark: SparkSession, paths: str | list[str], recursive: bool = False, glob: str = DUMP_GLOB
) -> DataFrame:
    """Every line (``value``) of the dump files at the paths. Plain files are split; a compressed
    one is a single task, so give it in many files or repartition after the scan."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
    return with_file_order(reader.text(paths))


def discover_inputs(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """The dump files below a folder with their sizes; only file names and lengths are read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", DUMP_GLOB)
        .option("recursiveFileLookup", recursive).load(path)
    )
    return files.select("path", "length")


def strip_and_skip_blank(lines: DataFrame) -> DataFrame:
    """Trimmed lines, blank ones dropped."""
    stripped = lines.withColumn("value", strip_whitespace(F.col("value")))
    return stripped.filter(F.length("value") > 0)
