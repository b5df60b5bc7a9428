"""Calendar columns, topic tags and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.config import Study, matched_column, topic_column
from moodtide.functions.dates import assign_time_period, epoch_to_timestamp, year_month
from moodtide.functions.topics import keyword_hits, matched_keywords, topic_flag
from moodtide.operators.guards import compute_once, require_columns

# Sentiment names of labels 0 and 1.
SENTIMENT_NAMES = ("negative", "positive")


def label_to_sentiment(label: str = "predicted_label"):
    negative, positive = SENTIMENT_NAMES
    return F.when(F.col(label) == 0, F.lit(negative)).when(F.col(label) == 1, F.lit(positive))


def add_time_columns(posts: DataFrame, study: Study) -> DataFrame:
    """Adds the UTC timestamp, year, month, ``YYYY-MM`` and period."""
    stamp = epoch_to_timestamp(F.col("created_utc"), dict(posts.dtypes)["created_utc"])
    stamped = posts.withColumn("created_datetime_utc", stamp)
    ts = F.col("created_datetime_utc")
    return stamped.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "year_month": year_month(ts),
            "time_period": assign_time_period(F.year(ts), study.periods),
        }
    )


def add_topic_columns(
    posts: DataFrame, study: Study, text: str = "cleaned_text", for_filter: bool = False
) -> DataFrame:
    """Adds per topic a 0/1 flag and the matched keywords, and the list, number and any-flag.

    Purely per row. The text is searched once; flags and keyword lists are read from the hits.
    Set ``for_filter`` if rows are going to be filtered by these columns: the search is then not
    repeated in the filter, at the price of being done even if no column is used.
    """
    search = keyword_hits(F.coalesce(text, F.lit("")), study.topics)
    require_columns(posts, (text,))
    found = compute_once(posts, _hits=search) if for_filter else posts.withColumn("_hits", search)
    hits = F.col("_hits")
    tagged = found.select(
        "*",
        *[topic_flag(hits, t).alias(topic_column(t.name)) for t in study.topics],
        *[matched_keywords(hits, t).alias(matched_column(t.name)) for t in study.topics],
    ).drop("_hits")
    names = [F.when(F.col(topic_column(t.name)) == 1, F.lit(t.name)) for t in study.topics]
    count = sum((F.col(c) for c in study.topic_columns), F.lit(0))
    return tagged.select(
        "*",
        F.concat_ws("; ", *names).alias("topic_list"),
        count.alias("num_topics"),
        (count > 0).cast("int").alias("has_any_topic"),
    )


def topic_definitions(spark, study: Study) -> DataFrame:
    """The configured topics as a table."""
    rows = [(i, t.name, t.description, list(t.keywords)) for i, t in enumerate(study.topics)]
    return spark.createDataFrame(
        rows, "topic_ord int, topic_bucket string, topic_description string, keywords array<string>"
    )


def topic_coverage(tagged: DataFrame, study: Study) -> DataFrame:
    """Posts and percentage per topic, and for "any topic", from one aggregate row."""
    flags = {**{t.name: topic_column(t.name) for t in study.topics}, "any_topic": "has_any_topic"}
    totals = tagged.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"n_{i}") for i, c in enumerate(flags.values())],
    )
    pieces = [
        F.struct(F.lit(name).alias("topic_bucket"), F.col(f"n_{i}").alias("topic_rows"))
        for i, name in enumerate(flags)
    ]
    pct = F.coalesce(F.try_divide(F.col("topic_rows") * 100.0, F.col("rows")), F.lit(0.0))
    return totals.select("rows", F.inline(F.array(*pieces))).select(
        "topic_bucket", "topic_rows", pct.alias("topic_pct")
    )


def num_topics_distribution(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("num_topics").agg(F.count(F.lit(1)).alias("posts")).orderBy("num_topics")


def topic_counts_by_group(tagged: DataFrame, study: Study) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in study.topic_columns]
    return tagged.groupBy("subreddit").agg(*sums).orderBy("subreddit")


def topic_post_long(tagged: DataFrame, study: Study, columns: tuple[str, ...]) -> DataFrame:
    """One row per (post, topic); a projection and a generator, no shuffle."""
    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(topic_column(t.name)) == 1,
                    F.struct(
                        F.lit(t.name).alias("topic_bucket"),
                        F.lit(t.description).alias("topic_description"),
                    ),
                )
                for t in study.topics
            ]
        )
    )
    return tagged.select(*columns, F.inline(entries))
