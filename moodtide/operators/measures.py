"""The one aggregate every table is built from.

``measured`` turns tagged posts into dimension columns plus additive measures (row weight 1).
``report_cube`` sums those measures per distinct dimension combination. Both have the same
columns, so each table operator accepts either: the raw rows for a single table, or the cube when
many tables are wanted and the posts should be read once. ``bucket_agg`` then computes any
"for each topic / period" table as conditional sums in a single hash aggregate, unpivoted
afterwards; no post is multiplied, joined or re-read, and hot groups are reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.config import Study, topic_column
from moodtide.functions.numeric import coerce_flag, coerce_label, numeric_column, safe_divide
from moodtide.functions.text import normalize_key, normalize_text
from moodtide.operators.guards import require_columns

MEASURES = ("posts", "prob_positive_sum", "prob_positive_n", "prob_negative_sum", "prob_negative_n")


def measured(tagged: DataFrame, study: Study) -> DataFrame:
    """Normalised dimensions, the label (NULL if not 0/1), 0/1 topic flags, and the measures."""
    require_columns(tagged, ("subreddit", "year_month", "time_period", "predicted_label"))
    flags = [
        numeric_column(tagged, c, coerce_flag).alias(c)
        for c in ("has_any_topic", *study.topic_columns)
    ]
    measures = [F.lit(1).cast("bigint").alias("posts")]
    for side in ("prob_positive", "prob_negative"):
        p = numeric_column(tagged, side)
        measures += [p.alias(f"{side}_sum"), p.isNotNull().cast("bigint").alias(f"{side}_n")]
    return tagged.select(
        normalize_key(F.col("subreddit")).alias("subreddit"),
        normalize_text(F.col("year_month")).alias("year_month"),
        normalize_text(F.col("time_period")).alias("time_period"),
        numeric_column(tagged, "predicted_label", coerce_label).alias("label"),
        *flags,
        *measures,
    )


def report_cube(rows: DataFrame, study: Study) -> DataFrame:
    """Measures per combination of dimensions: at most groups x months x labels x topic sets rows."""
    dims = ["subreddit", "year_month", "time_period", "label", "has_any_topic", *study.topic_columns]
    return rows.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in MEASURES])


def valid(rows: DataFrame) -> DataFrame:
    """Rows whose label is 0 or 1; all sentiment tables start here."""
    return rows.filter(F.col("label").isNotNull())


def total(measure: str = "posts", condition: Column | None = None) -> Column:
    """Sum of a measure, 0 where nothing qualifies."""
    value = F.col(measure) if condition is None else F.when(condition, F.col(measure))
    return F.coalesce(F.sum(value), F.lit(0))


def mean_prob(side: str, condition: Column | None = None) -> Column:
    """Mean probability over the rows that have one; NULL if none has."""
    s, n = F.col(f"{side}_sum"), F.col(f"{side}_n")
    if condition is not None:
        s, n = F.when(condition, s), F.when(condition, n)
    return F.try_divide(F.sum(s), F.sum(n))


POSITIVE = "label = 1"
NEGATIVE = "label = 0"


def sentiment_sums(condition: Column | None = None) -> dict[str, Column]:
    """Total, positive and negative posts among valid rows."""
    def with_label(predicate: str) -> Column:
        label = F.expr(predicate)
        return label if condition is None else condition & label

    return {
        "total_posts": total("posts", condition),
        "positive_posts": total("posts", with_label(POSITIVE)),
        "negative_posts": total("posts", with_label(NEGATIVE)),
    }


def sentiment_rates(prefix: str = "") -> dict[str, Column]:
    """Rates over the columns ``sentiment_sums`` makes."""
    return {
        f"{prefix}positive_rate": safe_divide(F.col("positive_posts"), F.col("total_posts")),
        f"{prefix}negative_rate": safe_divide(F.col("negative_posts"), F.col("total_posts")),
    }


def aliased(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def bucket_agg(rows, keys, buckets, measures, overall=None) -> DataFrame:
    """Per key: every bucket's measures, one output row per bucket, zero rows included.

    ``buckets`` is a list of (attributes, condition); ``measures`` maps a condition to named
    aggregates; ``overall`` are aggregates over all rows of the key, repeated on each output row.
    """
    overall = overall or {}
    plan = [(attrs, aliased_measures(measures(cond), i)) for i, (attrs, cond) in enumerate(buckets)]
    grouped = rows.groupBy(*keys) if keys else rows
    flat = grouped.agg(*aliased(overall), *[c for _, cols in plan for c in cols.values()])
    entries = [
        F.struct(
            *[F.lit(v).alias(k) for k, v in attrs.items()],
            *[F.col(f"b{i}_{name}").alias(name) for name in cols],
        )
        for i, (attrs, cols) in enumerate(plan)
    ]
    return flat.select(*keys, *overall, F.inline(F.array(*entries)))


def aliased_measures(measures: dict[str, Column], i: int) -> dict[str, Column]:
    return {name: c.alias(f"b{i}_{name}") for name, c in measures.items()}


def topic_buckets(study: Study) -> list[tuple[dict, Column]]:
    """One bucket per topic, carrying its place, name and description."""
    return [
        (
            {"topic_ord": i, "topic_bucket": t.name, "topic_description": t.description},
            F.col(topic_column(t.name)) == 1,
        )
        for i, t in enumerate(study.topics)
    ]


def period_buckets(names: tuple[str, ...]) -> list[tuple[dict, Column]]:
    """One bucket per configured period, so each appears even without posts."""
    return [
        ({"period_ord": i, "time_period": name}, F.col("time_period") == name)
        for i, name in enumerate(names)
    ]
