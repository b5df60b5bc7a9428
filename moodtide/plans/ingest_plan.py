"""Raw dumps to cleaned posts, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.config import Study
from moodtide.functions.text import null_literals
from moodtide.operators.ingest import FILE_ORDER, dedup_by_id, keep_accepted
from moodtide.operators.posts import build_final_text, keep_with_cleaned_text, select_fields
from moodtide.operators.tagging import add_time_columns, add_topic_columns
from moodtide.sources.csv import csv_null_literals
from moodtide.sources.text_lines import PLAIN_GLOB, scan_lines
from moodtide.sources.zst import scan_zst


def merged_posts(lines: DataFrame, study: Study, na_literals: bool = True) -> DataFrame:
    """Accepted, standardised posts, one per id.

    With ``na_literals`` the spellings a CSV reader takes for missing ("NA", "null", ...) are
    missing here too, as they are where the stages exchange CSV files.
    """
    kept = keep_accepted(lines, study)
    return dedup_by_id(csv_null_literals(kept) if na_literals else kept).drop(*FILE_ORDER)


def cleaned_posts(merged: DataFrame, na_literals: bool = True) -> DataFrame:
    """Posts with non-empty cleaned text."""
    cleaned = keep_with_cleaned_text(build_final_text(select_fields(merged)))
    return cleaned.filter(null_literals(F.col("cleaned_text")).isNotNull()) if na_literals else cleaned


def tagged_posts(cleaned: DataFrame, study: Study) -> DataFrame:
    """Calendar and topic columns; per row, no shuffle."""
    return add_topic_columns(add_time_columns(cleaned, study), study)


def scan_dumps(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of plain and of ``.zst`` dumps below the paths; the latter may have long windows."""
    paths = [paths] if isinstance(paths, str) else paths
    lines = scan_lines(spark, paths, recursive=True, glob=PLAIN_GLOB)
    for path in paths:
        lines = lines.unionByName(scan_zst(spark, path))
    return lines


def load_posts(spark: SparkSession, paths: str | list[str], study: Study) -> DataFrame:
    """Dump files to cleaned posts; the only shuffle is the one that removes duplicates."""
    return cleaned_posts(merged_posts(scan_dumps(spark, paths), study))
