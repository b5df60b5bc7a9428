"""Sentiment tables. Every function takes measured rows or the report cube."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodtide.config import SENTIMENTS, Study
from moodtide.functions.numeric import safe_divide
from moodtide.operators.measures import (
    aliased, bucket_agg, mean_prob, period_buckets, sentiment_rates, sentiment_sums, topic_buckets,
    total, valid,
)


def _tagged_posts():
    return F.coalesce(F.sum(F.col("has_any_topic") * F.col("posts")), F.lit(0))


def _tagged_share():
    return safe_divide(F.col("posts_with_any_topic"), F.col("total_posts")).alias("share_posts_with_any_topic")


def label_distribution(predicted: DataFrame) -> DataFrame:
    """Posts and percentage per predicted sentiment; the window runs over the few result rows."""
    counts = predicted.groupBy("predicted_sentiment").agg(F.count(F.lit(1)).alias("posts"))
    share = F.col("posts") * 100.0 / F.sum("posts").over(Window.partitionBy())
    return counts.select("predicted_sentiment", "posts", share.alias("pct")).orderBy(F.desc("posts"))


def _crosstab(predicted: DataFrame, key: str) -> DataFrame:
    counts = [
        F.count_if(F.coalesce(F.col("predicted_sentiment") == s, F.lit(False))).alias(s) for s in SENTIMENTS
    ]
    rows = predicted.filter(F.col("predicted_sentiment").isNotNull())
    return rows.groupBy(key).agg(*counts).orderBy(key)


def sentiment_by_group_crosstab(predicted: DataFrame) -> DataFrame:
    return _crosstab(predicted, "subreddit")


def sentiment_by_period_crosstab(predicted: DataFrame) -> DataFrame:
    return _crosstab(predicted, "time_period")


def posts_by_month(timed: DataFrame) -> DataFrame:
    """Posts per month; posts without a time form a NULL month."""
    return timed.groupBy("year_month").agg(F.count(F.lit(1)).alias("posts")).orderBy("year_month")


def posts_by_period(timed: DataFrame) -> DataFrame:
    return timed.groupBy("time_period").agg(F.count(F.lit(1)).alias("posts")).orderBy(F.desc("posts"))


def overall_summary(rows: DataFrame) -> DataFrame:
    """One row for the whole data set.

    The three distinct counts would triple the rows of a plain aggregate. Summing per dimension
    combination first leaves them a table of groups x months x periods.
    """
    dims = ["subreddit", "year_month", "time_period"]
    per_dim = valid(rows).groupBy(*dims).agg(
        *aliased(sentiment_sums()),
        _tagged_posts().alias("posts_with_any_topic"),
        *[F.sum(f"{s}_{m}").alias(f"{s}_{m}") for s in ("prob_positive", "prob_negative") for m in ("sum", "n")],
    )
    sums = ["total_posts", "positive_posts", "negative_posts", "posts_with_any_topic"]
    flat = per_dim.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        F.count_distinct("subreddit").alias("num_subreddits"),
        F.count_distinct(F.nullif(F.col("year_month"), F.lit(""))).alias("num_months"),
        F.count_distinct(F.nullif(F.col("time_period"), F.lit(""))).alias("num_time_periods"),
        mean_prob("prob_positive").alias("avg_prob_positive"),
        mean_prob("prob_negative").alias("avg_prob_negative"),
    )
    return flat.select(
        "total_posts", "positive_posts", "negative_posts", *aliased(sentiment_rates()),
        "num_subreddits", "num_months", "num_time_periods", "posts_with_any_topic", _tagged_share(),
        "avg_prob_positive", "avg_prob_negative",
    )


def sentiment_summary(rows: DataFrame, group_name: str) -> DataFrame:
    """The standard summary row of any subset of posts."""
    flat = valid(rows).agg(
        *aliased(sentiment_sums()),
        mean_prob("prob_positive").alias("avg_prob_positive"),
        mean_prob("prob_negative").alias("avg_prob_negative"),
    )
    return flat.select(F.lit(group_name).alias("group_name"), *summary_columns())


def summary_columns():
    """Counts, rates and means from the sums of a subset; means are NULL for an empty one."""
    mean_label = F.try_divide(F.col("positive_posts").cast("double"), F.col("total_posts").cast("double"))
    return [
        F.col("total_posts"), F.col("positive_posts"), F.col("negative_posts"),
        *aliased(sentiment_rates()),
        mean_label.alias("avg_predicted_label"),
        F.col("avg_prob_positive"), F.col("avg_prob_negative"),
    ]


def period_sentiment_table(rows: DataFrame, study: Study) -> DataFrame:
    """Every configured period in order, zeros where it has no posts."""
    table = bucket_agg(
        valid(rows), [], period_buckets(study.period_names),
        lambda cond: {
            **sentiment_sums(cond),
            "posts_with_any_topic": total("posts", cond & (F.col("has_any_topic") == 1)),
        },
    )
    return table.orderBy("period_ord").select(
        "time_period", "total_posts", "positive_posts", "negative_posts", *aliased(sentiment_rates()),
        "posts_with_any_topic", _tagged_share(),
    )


def group_sentiment_table(rows: DataFrame) -> DataFrame:
    table = valid(rows).groupBy("subreddit").agg(*aliased(sentiment_sums()))
    return table.select("*", *aliased(sentiment_rates())).orderBy(F.desc("total_posts"), "subreddit")


def monthly_sentiment_table(rows: DataFrame) -> DataFrame:
    """Observed months only."""
    table = (
        valid(rows).filter(F.col("year_month") != "").groupBy("year_month")
        .agg(*aliased(sentiment_sums()), _tagged_posts().alias("posts_with_any_topic"))
    )
    return table.orderBy("year_month").select(
        "year_month", "total_posts", "positive_posts", "negative_posts", *aliased(sentiment_rates()),
        "posts_with_any_topic", _tagged_share(),
    )


def _overall():
    return {
        "all_posts": total(),
        "all_positive": total("posts", F.expr("label = 1")),
        "all_negative": total("posts", F.expr("label = 0")),
    }


def topic_sentiment_table(rows: DataFrame, study: Study) -> DataFrame:
    """Report table per topic; the difference to the overall rate is NULL for an unused topic."""
    table = bucket_agg(
        valid(rows), [], topic_buckets(study),
        lambda cond: {**sentiment_sums(cond), "avg_prob_positive": mean_prob("prob_positive", cond)},
        _overall(),
    )
    delta = safe_divide(F.col("positive_posts"), F.col("total_posts")) - safe_divide(
        F.col("all_positive"), F.col("all_posts")
    )
    return table.select(
        "topic_bucket", "topic_description", "total_posts", "positive_posts", "negative_posts",
        *aliased(sentiment_rates()),
        safe_divide(F.col("total_posts"), F.col("all_posts")).alias("share_of_all_posts"),
        F.when(F.col("total_posts") > 0, delta).alias("positive_rate_minus_overall"),
        "avg_prob_positive",
    ).orderBy(F.desc("total_posts"), "topic_bucket")


def topic_sentiment_summary(rows: DataFrame, study: Study) -> DataFrame:
    """Comparison table per topic in configured order; an unused topic has rates 0.0."""
    table = bucket_agg(
        valid(rows), [], topic_buckets(study),
        lambda cond: {
            **sentiment_sums(cond),
            "avg_prob_positive": mean_prob("prob_positive", cond),
            "avg_prob_negative": mean_prob("prob_negative", cond),
        },
        _overall(),
    )
    table = table.select(
        "topic_ord", "topic_bucket", "topic_description", *summary_columns(),
        safe_divide(F.col("all_positive"), F.col("all_posts")).alias("overall_positive_rate"),
        safe_divide(F.col("all_negative"), F.col("all_posts")).alias("overall_negative_rate"),
    )
    return table.select(
        "*",
        (F.col("positive_rate") - F.col("overall_positive_rate")).alias("positive_rate_minus_overall"),
        (F.col("negative_rate") - F.col("overall_negative_rate")).alias("negative_rate_minus_overall"),
    ).orderBy("topic_ord")


def rank_topics(summary: DataFrame, side: str) -> DataFrame:
    """Topics by positive or negative rate, ties by volume, then configured order."""
    order = Window.partitionBy().orderBy(F.desc(f"{side}_rate"), F.desc("total_posts"), "topic_ord")
    rank = F.row_number().over(order).alias(f"{side}_rank")
    return summary.select(rank, *[c for c in summary.columns if c != "topic_ord"])


def topk_topics(topic_table: DataFrame, k: int = 3) -> DataFrame:
    """Top topics by frequency, positive and negative rate; for the rates, topics without posts
    are left out after the cut. Ranks the rows of the per-topic table, one per topic."""
    lists = (("frequency", "total_posts"), ("positive", "positive_rate"), ("negative", "negative_rate"))
    ranks = [
        F.row_number().over(Window.partitionBy().orderBy(F.desc(c), "topic_bucket")).alias(f"r_{name}")
        for name, c in lists
    ]
    entries = [
        F.when(
            (F.col(f"r_{name}") <= k) & (F.lit(name == "frequency") | (F.col("total_posts") > 0)),
            F.struct(
                F.lit(name).alias("ranking"),
                F.col(f"r_{name}").alias("place"),
                F.col("topic_bucket"),
                F.col(c).cast("double").alias("value"),
                F.col("total_posts"),
            ),
        )
        for name, c in lists
    ]
    ranked = topic_table.select("*", *ranks)
    return ranked.select(F.inline(F.array_compact(F.array(*entries)))).orderBy("ranking", "place")


def chart_rates(table: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Positive rate of the rows with posts, optionally sorted by it."""
    rows = table.filter(F.col("total_posts") > 0).select(key, "positive_rate", "total_posts")
    return rows.orderBy(F.desc(order), key) if order else rows


def topic_monthly_table(rows: DataFrame, study: Study) -> DataFrame:
    """(month, topic) for observed months, every topic present."""
    table = bucket_agg(
        valid(rows).filter(F.col("year_month") != ""), ["year_month"], topic_buckets(study),
        sentiment_sums, {"total_posts_in_month": total()},
    )
    return table.select(
        "year_month", "topic_bucket", "topic_description", "total_posts_in_month",
        F.col("total_posts").alias("topic_posts_in_month"),
        safe_divide(F.col("total_posts"), F.col("total_posts_in_month")).alias("topic_share_of_all_posts"),
        *aliased(sentiment_rates("topic_")),
    ).orderBy("topic_bucket", "year_month")


def indexed_topic_trend(topic_monthly: DataFrame) -> DataFrame:
    """Each topic's monthly posts as a percentage of its first non-zero month."""
    series = Window.partitionBy("topic_bucket").orderBy("year_month").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    count = F.col("topic_posts_in_month")
    first = F.first(F.nullif(count, F.lit(0)), ignorenulls=True).over(series)
    return topic_monthly.select(
        "year_month", "topic_bucket",
        F.coalesce(F.try_divide(count.cast("double"), first.cast("double")) * 100.0, F.lit(0.0)).alias("indexed_count"),
    )


def topics_by_total_volume(topic_monthly: DataFrame) -> DataFrame:
    volume = topic_monthly.groupBy("topic_bucket").agg(F.sum("topic_posts_in_month").alias("total_volume"))
    return volume.orderBy(F.desc("total_volume"), "topic_bucket")
