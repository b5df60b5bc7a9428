"""All tables of the study from a few passes over the tagged posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.config import Study
from moodtide.operators import hypotheses as h
from moodtide.operators import sentiment as s
from moodtide.operators import trends as t
from moodtide.operators import users as u
from moodtide.operators.measures import measured, report_cube
from moodtide.operators.tagging import topic_post_long
from moodtide.session import durable
from moodtide.sources.csv import write_csv


def report_tables(tagged: DataFrame, study: Study) -> dict[str, DataFrame]:
    """Every table, keyed by its name.

    Posts are read three times in all: into the cube of additive measures, into the row per author,
    and to count raw author names. Cube and author rows are written to the checkpoint folder, and
    all other tables are derived from them.
    """
    cube = durable(report_cube(measured(tagged, study), study))
    authors = durable(u.author_topics(u.authored(tagged, study), study))
    topic_table = s.topic_sentiment_table(cube, study)
    topic_summary = s.topic_sentiment_summary(cube, study)
    topic_monthly = s.topic_monthly_table(cube, study)
    trends = t.topic_monthly_trends_long(cube, study)
    user_topics = u.user_topic_sentiment_long(authors, study)
    matrix = u.topic_correlation_matrix(authors, study)
    ai_months = h.monthly_ai_sentiment(cube, study)
    return {
        "overall_summary": s.overall_summary(cube),
        "time_period_sentiment_table": s.period_sentiment_table(cube, study),
        "subreddit_sentiment_table": s.group_sentiment_table(cube),
        "topic_sentiment_table": topic_table,
        "monthly_sentiment_table": s.monthly_sentiment_table(cube),
        "topic_monthly_table": topic_monthly,
        "hypothesis_overview_table": h.hypothesis_readiness(tagged, cube, study),
        "topic_sentiment_summary": topic_summary.drop("topic_ord"),
        "topic_sentiment_ranked_positive": s.rank_topics(topic_summary, "positive"),
        "topic_sentiment_ranked_negative": s.rank_topics(topic_summary, "negative"),
        "monthly_post_totals": t.monthly_post_totals(cube, study),
        "topic_monthly_trends_long": trends,
        "topic_monthly_trends_wide_counts": t.trend_pivot(trends, study, "counts"),
        "topic_monthly_trends_wide_share_all_posts": t.trend_pivot(trends, study, "share_all"),
        "topic_monthly_trends_wide_share_topic_tagged_posts": t.trend_pivot(trends, study, "share_tagged"),
        "topic_time_period_summary": t.topic_period_summary(cube, study),
        "topic_subreddit_monthly_trends": t.topic_group_monthly_trends(cube, study),
        "topic_overall_frequency_summary": t.topic_overall_frequency(cube, study),
        "topic_monthly_indexed": s.indexed_topic_trend(topic_monthly),
        "h1_recruiting_pre_vs_post_period_summary": h.recruiting_period_summary(cube, study),
        "h1_recruiting_pre_vs_post_test": h.recruiting_proportion_test(cube, study),
        "h2_layoffs_frequency_by_period": h.layoffs_frequency_by_period(cube, study),
        "h2_layoffs_frequency_tests": h.layoffs_frequency_test(cube, study),
        "h2_layoffs_sentiment_tests": h.layoffs_sentiment_tests(cube, study),
        "h3_user_topic_sentiment_long": user_topics,
        "h3_user_topic_sentiment_wide": u.user_topic_wide(authors, study),
        "h3_user_topic_correlation_matrix": matrix,
        "h3_topic_user_coverage": u.topic_user_coverage(user_topics),
        "h3_summary": u.user_summary(authors, study),
        "h4_monthly_ai_sentiment_trends": ai_months,
        "h4_ai_sentiment_correlation": h.ai_sentiment_correlation(ai_months),
    }


#: Columns of the one table that has a row per post and topic.
POST_COLUMNS = (
    "id", "subreddit", "year_month", "time_period", "predicted_label", "predicted_sentiment", "prob_negative", "prob_positive",
)


def write_report(tagged: DataFrame, study: Study, out: str) -> list[str]:
    """Write every table as CSV below ``out``; returns the table names. The table with a row per post and
    topic is as large as the posts and is written as Parquet, if ``tagged`` has its columns."""
    tables = report_tables(tagged, study)
    for name, table in tables.items():
        write_csv(table, f"{out.rstrip('/')}/{name}")
    if not set(POST_COLUMNS) <= set(tagged.columns):
        return list(tables)
    labelled = tagged.filter(F.col("predicted_label").isin(0, 1))
    topic_post_long(labelled, study, POST_COLUMNS).write.parquet(f"{out.rstrip('/')}/topic_post_long_format")
    return [*tables, "topic_post_long_format"]
