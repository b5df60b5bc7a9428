"""Topic frequency over time. Unlike the sentiment tables these count every post, labelled or not."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodtide.config import Study, topic_column
from moodtide.functions.numeric import safe_divide
from moodtide.operators.measures import bucket_agg, topic_buckets, total

_ISO_MONTH = "^[0-9]{4}-(0[1-9]|1[0-2])$"


def _topic_posts(study: Study) -> dict:
    return {
        c: F.coalesce(F.sum(F.col(c) * F.col("posts")), F.lit(0)) for c in study.topic_columns
    }


def _count_posts(condition):
    return {"topic_post_count": total("posts", condition)}


def _tagged():
    return F.coalesce(F.sum(F.col("has_any_topic") * F.col("posts")), F.lit(0))


def fill_month_gaps(monthly: DataFrame, counts: list[str]) -> DataFrame:
    """Every month from the first to the last, missing ones with zero counts.

    Each row is stretched over the gap to the next observed month, so no calendar is joined and
    the table is read once. Works on the monthly totals only: the window sees one row per month.
    """
    month = F.to_date(F.concat("year_month", F.lit("-01")))
    following = F.lead("_month").over(Window.partitionBy().orderBy("_month"))
    until = F.coalesce(F.add_months(F.col("_next"), -1), F.col("_month"))
    span = F.explode(F.sequence("_month", until, F.expr("interval 1 month")))
    stretched = (
        monthly.filter(F.col("year_month").rlike(_ISO_MONTH))
        .withColumn("_month", month)
        .withColumn("_next", following)
        .select("_month", *counts, span.alias("_each"))
    )
    observed = F.col("_month") == F.col("_each")
    return stretched.select(
        F.date_format("_each", "yyyy-MM").alias("year_month"),
        *[F.when(observed, F.col(c)).otherwise(F.lit(0)).alias(c) for c in counts],
    )


def full_month_index(rows: DataFrame) -> DataFrame:
    """Every month between the first and last observed one."""
    months = rows.filter(F.col("year_month").rlike(_ISO_MONTH)).agg(
        F.min("year_month").alias("lo"), F.max("year_month").alias("hi")
    )
    first, last = (F.to_date(F.concat(c, F.lit("-01"))) for c in ("lo", "hi"))
    every = F.explode(F.sequence(first, last, F.expr("interval 1 month")))
    return months.select(every.alias("m")).select(F.date_format("m", "yyyy-MM").alias("year_month"))


def sort_months(rows: DataFrame) -> DataFrame:
    """Distinct observed months in calendar order, blanks dropped."""
    return rows.select("year_month").filter(F.col("year_month") != "").distinct().orderBy("year_month")


def _dense_months(rows: DataFrame, study: Study) -> DataFrame:
    measures = {
        "total_posts_in_month": total(),
        "topic_tagged_posts_in_month": _tagged(),
        **_topic_posts(study),
    }
    monthly = rows.filter(F.col("year_month") != "").groupBy("year_month").agg(
        *[c.alias(n) for n, c in measures.items()]
    )
    return fill_month_gaps(monthly, list(measures))


def monthly_post_totals(rows: DataFrame, study: Study) -> DataFrame:
    """All posts and topic-tagged posts per month, without gaps."""
    dense = _dense_months(rows, study)
    return dense.select("year_month", "total_posts_in_month", "topic_tagged_posts_in_month").orderBy("year_month")


def topic_monthly_trends_long(rows: DataFrame, study: Study) -> DataFrame:
    """(month, topic) without gaps: count, share of all posts and of topic-tagged posts."""
    entries = F.array(
        *[
            F.struct(
                F.lit(t.name).alias("topic_bucket"),
                F.lit(t.description).alias("topic_description"),
                F.col(topic_column(t.name)).alias("topic_post_count"),
            )
            for t in study.topics
        ]
    )
    long = _dense_months(rows, study).select(
        "year_month", "total_posts_in_month", "topic_tagged_posts_in_month", F.inline(entries)
    )
    return long.select(
        "year_month", "topic_bucket", "topic_description", "total_posts_in_month",
        "topic_tagged_posts_in_month", "topic_post_count",
        *_shares("total_posts_in_month", "topic_tagged_posts_in_month"),
    )


def _shares(all_posts: str, tagged_posts: str):
    count = F.col("topic_post_count")
    return [
        safe_divide(count, F.col(all_posts)).alias("topic_share_of_all_posts"),
        safe_divide(count, F.col(tagged_posts)).alias("topic_share_of_topic_tagged_posts"),
    ]


# Which value each wide table shows.
WIDE_VALUES = {
    "counts": "topic_post_count",
    "share_all": "topic_share_of_all_posts",
    "share_tagged": "topic_share_of_topic_tagged_posts",
}


def trend_pivot(long: DataFrame, study: Study, kind: str) -> DataFrame:
    """Month x topic, topics alphabetical, zeros where absent."""
    value = WIDE_VALUES[kind]
    wide = long.groupBy("year_month").pivot("topic_bucket", sorted(study.topic_names)).agg(F.first(value))
    return wide.fillna(0).orderBy("year_month")


def topic_period_summary(rows: DataFrame, study: Study) -> DataFrame:
    """(period, topic) for every period present in the data."""
    table = bucket_agg(
        rows.filter(F.col("time_period") != ""), ["time_period"], topic_buckets(study), _count_posts,
        {"total_posts_in_period": total(), "topic_tagged_posts_in_period": _tagged()},
    )
    return table.select(
        "time_period", "topic_bucket", "topic_description", "total_posts_in_period",
        "topic_tagged_posts_in_period", "topic_post_count",
        *_shares("total_posts_in_period", "topic_tagged_posts_in_period"),
    )


def topic_group_monthly_trends(rows: DataFrame, study: Study) -> DataFrame:
    """(month, group, topic) for every month and group that occur together."""
    table = bucket_agg(
        rows, ["year_month", "subreddit"], topic_buckets(study), _count_posts,
        {"total_posts_in_month_subreddit": total()},
    )
    return table.select(
        "year_month", "subreddit", "total_posts_in_month_subreddit", "topic_post_count", "topic_bucket",
        "topic_description",
        safe_divide(F.col("topic_post_count"), F.col("total_posts_in_month_subreddit")).alias(
            "topic_share_of_all_posts"
        ),
    )


def topic_overall_frequency(rows: DataFrame, study: Study) -> DataFrame:
    table = bucket_agg(rows, [], topic_buckets(study), _count_posts, {"all_posts": total()})
    return table.select(
        "topic_bucket", "topic_post_count",
        safe_divide(F.col("topic_post_count"), F.col("all_posts")).alias("topic_share_of_all_posts"),
    ).orderBy(F.desc("topic_post_count"), "topic_bucket")
