"""CSV in and out with the quoting the post tables need, and the labelled training file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.functions.text import NA_LITERALS, null_literals
from moodtide.sources.text_lines import with_file_order

# Columns and encoding of the labelled file, and the stage schemas.
LABELED_SCHEMA = "label int, id string, date string, flag string, user string, text string"
LABELED_ENCODING = "ISO-8859-1"
STANDARD_SCHEMA = (
    "source_type string, id string, subreddit string, author string, created_utc double, title string, "
    "body string, score bigint, num_comments bigint, permalink string, url string"
)
FILTERED_GLOB = "*_filtered.csv"
_QUOTING = {
    "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def scan_labeled_csv(spark: SparkSession, path: str, encoding: str = LABELED_ENCODING) -> DataFrame:
    """Headerless label, id, date, flag, user, text."""
    return spark.read.schema(LABELED_SCHEMA).options(**_QUOTING).option("encoding", encoding).csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """UTF-8 CSV, every string quoted so that text with line breaks survives."""
    (
        df.write.options(**_QUOTING).option("header", header).option("quoteAll", True)
        .option("nullValue", "").option("emptyValue", "").csv(path)
    )


def scan_csv(spark: SparkSession, path: str | list[str], schema: str, glob: str | None = None) -> DataFrame:
    """Headed CSV with a fixed schema; quoted fields may span lines (then one task per file)."""
    reader = spark.read.schema(schema).options(**_QUOTING).option("header", True).option("multiLine", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path)


def csv_null_literals(df: DataFrame, literals: tuple[str, ...] = NA_LITERALS) -> DataFrame:
    """String columns with the missing-value spellings as NULL."""
    return df.select(
        *[null_literals(F.col(n), literals).alias(n) if t == "string" else F.col(n) for n, t in df.dtypes]
    )


def scan_glob_union(
    spark: SparkSession, path: str, schema: str = STANDARD_SCHEMA, glob: str = FILTERED_GLOB
) -> DataFrame:
    """All filtered files of a folder as one frame, each row knowing its file and place in it."""
    return with_file_order(scan_csv(spark, path, schema, glob))


def rows_per_file(scanned: DataFrame) -> DataFrame:
    """Rows by file name."""
    name = F.element_at(F.split("src_file", "/"), -1).alias("file")
    return scanned.groupBy(name).agg(F.count(F.lit(1)).alias("rows")).orderBy("file")
