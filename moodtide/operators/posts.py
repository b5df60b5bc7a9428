"""From standard posts to cleaned text, with the accounting of each step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.functions.numeric import numeric_column
from moodtide.functions.text import clean_text, normalize_text, normalize_text_placeholders
from moodtide.operators.guards import compute_once, project_columns

# The fields kept for analysis.
SELECTED_COLUMNS = ("id", "subreddit", "author", "created_utc", "title", "body")
TEXT_COLUMNS = ("id", "subreddit", "author", "title", "body")


def select_fields(posts: DataFrame) -> DataFrame:
    """The analysis fields, text trimmed and time numeric."""
    picked = project_columns(posts, SELECTED_COLUMNS)
    return picked.select(
        *[
            (numeric_column(posts, c) if c == "created_utc" else normalize_text(F.col(c))).alias(c)
            for c in SELECTED_COLUMNS
        ]
    )


def missing_value_profile(selected: DataFrame) -> DataFrame:
    """One row: empty values per text column and posts without a time."""
    empty = [F.count_if(F.col(c) == "").alias(f"missing_{c}") for c in TEXT_COLUMNS]
    return selected.agg(*empty, F.count_if(F.col("created_utc").isNull()).alias("missing_created_utc"))


def join_title_body(title: Column, body: Column) -> Column:
    """Title and body with a blank between, or whichever is there."""
    return F.concat_ws(" ", F.nullif(title, F.lit("")), F.nullif(body, F.lit("")))


def normalize_post_fields(selected: DataFrame) -> DataFrame:
    """Placeholder markers in any text field as the empty string; computed once per row."""
    fields = {c: normalize_text_placeholders(F.col(c)) for c in TEXT_COLUMNS}
    fields["created_utc"] = numeric_column(selected, "created_utc")
    return compute_once(project_columns(selected, SELECTED_COLUMNS), **fields).select(*SELECTED_COLUMNS)


def with_final_text(selected: DataFrame) -> DataFrame:
    """Normalised posts with ``final_text``, empty ones included."""
    text = join_title_body(F.col("title"), F.col("body"))
    return normalize_post_fields(selected).withColumn("final_text", text)


def build_final_text(selected: DataFrame) -> DataFrame:
    """Posts that have any text, with ``final_text``."""
    return with_final_text(selected).filter((F.col("title") != "") | (F.col("body") != ""))


def title_body_availability(normalized: DataFrame) -> DataFrame:
    """One row: posts with both, one or neither of title and body."""
    title, body = F.col("title") != "", F.col("body") != ""
    return normalized.agg(
        F.count_if(title & body).alias("both_present"),
        F.count_if(title & ~body).alias("title_only"),
        F.count_if(~title & body).alias("body_only"),
        F.count_if(~title & ~body).alias("both_empty"),
    )


def with_cleaned_text(posts: DataFrame, text: str = "final_text") -> DataFrame:
    """Adds ``cleaned_text``: a plain projection, dropped from the plan where nothing uses it."""
    return posts.withColumn("cleaned_text", clean_text(normalize_text(F.col(text))))


def drop_empty_text(posts: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """Rows whose text is neither missing nor blank."""
    return posts.filter(F.coalesce(F.length(F.trim(F.col(text))) > 0, F.lit(False)))


def keep_with_cleaned_text(posts: DataFrame, text: str = "final_text") -> DataFrame:
    """Adds ``cleaned_text`` and drops the rows where it is empty, cleaning each text once."""
    return drop_empty_text(compute_once(posts, cleaned_text=clean_text(normalize_text(F.col(text)))))


def drop_accounting(posts: DataFrame, kept: Column) -> DataFrame:
    """One row: rows before, dropped and remaining under a keep condition, in one pass."""
    keep = F.coalesce(kept, F.lit(False))
    return posts.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~keep).alias("rows_dropped"),
        F.count_if(keep).alias("rows_remaining"),
    )


def recode_label(posts: DataFrame) -> DataFrame:
    """Labels 0 and 4 as 0 and 1; rows with any other label dropped."""
    label = F.col("label")
    recoded = F.when(label == 4, F.lit(1)).when(label == 0, F.lit(0))
    return posts.filter(label.isin(0, 4)).withColumn("label", recoded)


def preprocess_labeled(labeled: DataFrame) -> DataFrame:
    """Labelled rows with cleaned, non-empty text."""
    return keep_with_cleaned_text(labeled, "text")
