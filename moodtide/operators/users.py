"""Per-author topic sentiment and its correlations.

Everything rests on one aggregate: a row per author with the post count and, per topic, the sums
behind the means. The minimum-posts rule is a filter on that row, so no post is joined back to its
author, and a prolific author is reduced map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.config import Study, topic_column
from moodtide.functions.numeric import coerce_flag, coerce_label, guarded_correlation, numeric_column
from moodtide.functions.text import normalize_author
from moodtide.operators.guards import compute_once, require_columns
from moodtide.session import durable

SIDES = ("prob_positive", "prob_negative")


def authored(tagged: DataFrame, study: Study) -> DataFrame:
    """Valid posts of usable authors, reduced to what the author tables need."""
    require_columns(tagged, ("author", "predicted_label", *study.topic_columns))
    rows = tagged.select(
        normalize_author(F.col("author")).alias("author_norm"),
        numeric_column(tagged, "predicted_label", coerce_label).alias("label"),
        *[numeric_column(tagged, c, coerce_flag).alias(c) for c in study.topic_columns],
        *[numeric_column(tagged, s).alias(s) for s in SIDES],
    )
    return rows.filter((F.col("author_norm") != "") & F.col("label").isNotNull())


def author_post_counts(posts: DataFrame, min_posts: int = 1) -> DataFrame:
    """Posts per author, authors below the minimum left out."""
    counts = posts.groupBy("author_norm").agg(F.count(F.lit(1)).alias("total_posts_by_user"))
    return counts.filter(F.col("total_posts_by_user") >= min_posts)


def semi_join_eligible_authors(posts: DataFrame, min_posts: int) -> DataFrame:
    """The posts whose author has at least ``min_posts`` posts.

    A plain semi join with the written counts: the side of the posts comes straight from its shuffle, so
    the partitions of prolific authors are split at run time.
    """
    eligible = durable(author_post_counts(posts, min_posts))
    return posts.join(eligible, "author_norm", "left_semi")


def author_topics(posts: DataFrame, study: Study) -> DataFrame:
    """One row per eligible author: total posts and, per topic, an array entry of its sums."""
    def sums(i: int, cond: Column) -> list[Column]:
        out = [F.count_if(cond).alias(f"n{i}"), F.sum(F.when(cond, F.col("label"))).alias(f"l{i}")]
        return out + [F.avg(F.when(cond, F.col(s))).alias(f"{s}{i}") for s in SIDES]

    aggs = [a for i, c in enumerate(study.topic_columns) for a in sums(i, F.col(c) == 1)]
    per_author = posts.groupBy("author_norm").agg(F.count(F.lit(1)).alias("total_posts_by_user"), *aggs)
    return per_author.filter(F.col("total_posts_by_user") >= study.min_user_posts)


def user_topic_sentiment_long(authors: DataFrame, study: Study) -> DataFrame:
    """(author, topic) rows for the topics an eligible author posted in."""
    entries = [
        F.when(
            F.col(f"n{i}") > 0,
            F.struct(
                F.col(f"n{i}").alias("posts_in_topic"),
                (F.col(f"l{i}") / F.col(f"n{i}")).alias("avg_predicted_label"),
                F.col(f"prob_positive{i}").alias("avg_prob_positive"),
                F.col(f"prob_negative{i}").alias("avg_prob_negative"),
                F.lit(t.name).alias("topic_bucket"),
                F.lit(t.description).alias("topic_description"),
            ),
        )
        for i, t in enumerate(study.topics)
    ]
    return authors.select("author_norm", F.inline(F.array_compact(F.array(*entries))))


def topic_user_coverage(long: DataFrame) -> DataFrame:
    """Per topic: users, posts and the mean of the users' means. An author has one row per
    topic, so counting rows counts users."""
    return long.groupBy("topic_bucket").agg(
        F.count(F.lit(1)).alias("users_with_topic"),
        F.sum("posts_in_topic").alias("total_topic_posts_from_eligible_users"),
        F.avg("avg_predicted_label").alias("mean_user_topic_sentiment"),
    )


def _mean(i: int) -> Column:
    return F.try_divide(F.col(f"l{i}").cast("double"), F.col(f"n{i}").cast("double"))


def user_topic_wide(authors: DataFrame, study: Study) -> DataFrame:
    """Author x topic mean sentiment, NULL where an author has no posts in a topic; authors
    without any topic are left out."""
    names = list(study.topic_names)
    wide = authors.select("author_norm", *[_mean(i).alias(n) for i, n in enumerate(names)])
    return wide.filter(F.coalesce(*[F.col(n) for n in names]).isNotNull()).select("author_norm", *sorted(names))


def _pair_correlations(authors: DataFrame, size: int) -> DataFrame:
    """(a, b, correlation) for topic numbers a <= b that some author has both of.

    One aggregate keyed by the pair, whatever the number of topics: a row is multiplied only by the pairs of
    topics its author posted in, and each task keeps one co-moment state per pair.
    """
    means = [F.when(_mean(i).isNotNull(), F.struct(F.lit(i).alias("t"), _mean(i).alias("m"))) for i in range(size)]
    own = compute_once(authors, _own=F.array_compact(F.array(*means)))

    def pairs_with(a: Column) -> Column:
        later = F.filter("_own", lambda b: b["t"] >= a["t"])
        return F.transform(later, lambda b: F.struct(a["t"].alias("a"), b["t"].alias("b"), a["m"].alias("x"), b["m"].alias("y")))

    pairs = own.select(F.inline(F.flatten(F.transform("_own", pairs_with))))
    return pairs.groupBy("a", "b").agg(guarded_correlation(F.col("x"), F.col("y")).alias("correlation"))


def topic_correlation_matrix(authors: DataFrame, study: Study) -> DataFrame:
    """Long, symmetric Pearson matrix of the authors' topic means, diagonal included.

    Each pair is over the author rows where both topics are present, NULL where there is none: no author
    is joined with itself. Topics nobody posted in have no row.
    """
    size, names = len(study.topics), F.array(*[F.lit(n) for n in study.topic_names])
    place = F.col("a") * size + F.col("b")
    known = _pair_correlations(authors, size).agg(
        F.map_from_entries(F.collect_list(F.struct(place.alias("p"), "correlation"))).alias("r")
    )
    used = known.select("r", F.filter(F.map_keys("r"), lambda p: p % (size + 1) == 0).alias("diagonal"))
    number = lambda p: (p / (size + 1)).cast("int")
    entry = lambda a, b: F.struct(
        F.get(names, a).alias("topic_a"), F.get(names, b).alias("topic_b"),
        F.element_at("r", F.least(a, b) * size + F.greatest(a, b)).alias("correlation"),
    )
    rows = F.transform("diagonal", lambda p: F.transform("diagonal", lambda q: entry(number(p), number(q))))
    return used.select(F.inline(F.flatten(rows)))


def correlation_melt(matrix: DataFrame) -> DataFrame:
    """Off-diagonal entries."""
    return matrix.filter(F.col("topic_a") != F.col("topic_b"))


def user_summary(authors: DataFrame, study: Study) -> DataFrame:
    """The H3 row: eligible users, user-topic rows, topics with data and the largest
    off-diagonal correlation. The note texts are fixed values."""
    size = len(study.topics)
    pairs = _pair_correlations(authors, size).filter("a < b")
    largest = pairs.agg(F.max(F.abs("correlation"))).scalar()
    flat = authors.agg(
        F.count(F.lit(1)).alias("eligible_users"), *[F.count_if(F.col(f"n{i}") > 0).alias(f"u{i}") for i in range(size)]
    ).withColumn("largest", largest)
    users = [F.col(f"u{i}") for i in range(size)]
    rows = sum(users, F.lit(0).cast("bigint"))
    return flat.select(
        F.lit("H3").alias("hypothesis"),
        F.lit(study.min_user_posts).alias("min_user_posts"),
        "eligible_users",
        rows.alias("user_topic_rows"),
        sum(((u > 0).cast("bigint") for u in users), F.lit(0).cast("bigint")).alias("num_topic_buckets_with_user_data"),
        F.col("largest").alias("max_abs_topic_correlation"),
        F.coalesce(F.col("largest") > 0, F.lit(False)).alias("supports_h3_measurable_correlations"),
        F.when(rows > 0, F.lit("Correlation matrix based on user-level average predicted sentiment by topic."))
        .otherwise(F.lit("Insufficient eligible user-topic data.")).alias("note"),
    )
