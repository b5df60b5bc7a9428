"""Hypothesis tables. Each takes measured rows or the report cube and reads it once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.config import Study, topic_column
from moodtide.functions.numeric import (
    coerce_label, guarded_correlation, numeric_column, safe_divide, two_proportion_z_test,
)
from moodtide.functions.text import normalize_text
from moodtide.operators.measures import (
    aliased, bucket_agg, mean_prob, period_buckets, sentiment_sums, total, valid,
)
from moodtide.operators.sentiment import summary_columns


# The hypothesis names, statements, status words and notes below are those of the result tables.


def _flag(topic: str):
    return F.col(topic_column(topic)) == 1


def recruiting_period_summary(rows: DataFrame, study: Study) -> DataFrame:
    """H1: sentiment of the recruiting topic, before and after."""
    topic = _flag(study.recruiting_topic)
    table = bucket_agg(
        valid(rows), [], period_buckets((study.before_period, study.after_period)),
        lambda cond: {
            **sentiment_sums(cond & topic),
            "avg_prob_positive": mean_prob("prob_positive", cond & topic),
            "avg_prob_negative": mean_prob("prob_negative", cond & topic),
        },
    )
    return table.orderBy("period_ord").select(
        F.col("time_period").alias("group_name"), *summary_columns(), "time_period"
    )


def recruiting_proportion_test(rows: DataFrame, study: Study) -> DataFrame:
    """H1: after minus before, for the positive and the negative rate."""
    topic = _flag(study.recruiting_topic)
    sides = {"pre": study.before_period, "post": study.after_period}
    sums = {}
    for side, period in sides.items():
        here = topic & (F.col("time_period") == period)
        sums[f"{side}_total"] = total("posts", here)
        sums[f"{side}_pos"] = total("posts", here & (F.col("label") == 1))
        sums[f"{side}_neg"] = total("posts", here & (F.col("label") == 0))
    flat = valid(rows).agg(*aliased(sums))
    c = {name: F.col(name) for name in sums}
    positive = two_proportion_z_test(c["post_pos"], c["post_total"], c["pre_pos"], c["pre_total"])
    negative = two_proportion_z_test(c["post_neg"], c["post_total"], c["pre_neg"], c["pre_total"])
    rate = {f"{s}_{k}": safe_divide(c[f"{s}_{k}"], c[f"{s}_total"]) for s in sides for k in ("pos", "neg")}
    enough = (c["pre_total"] > 0) & (c["post_total"] > 0)
    supports = enough & (rate["post_pos"] < rate["pre_pos"]) & (rate["post_neg"] > rate["pre_neg"])
    after, before = study.after_period, study.before_period
    direction = f"H1 direction means {after} recruiting sentiment should be more negative than {before}."
    too_few = f"Insufficient {before} or {after} recruiting data for direct comparison."
    return flat.select(
        F.lit("H1").alias("hypothesis"),
        F.lit(study.recruiting_topic).alias("topic_bucket"),
        c["pre_total"].alias("pre_total_posts"),
        c["post_total"].alias("post_total_posts"),
        rate["pre_pos"].alias("pre_positive_rate"),
        rate["post_pos"].alias("post_positive_rate"),
        positive.difference.alias("post_minus_pre_positive_rate"),
        positive.z.alias("positive_rate_z_stat"),
        positive.p.alias("positive_rate_p_value_two_sided"),
        rate["pre_neg"].alias("pre_negative_rate"),
        rate["post_neg"].alias("post_negative_rate"),
        negative.difference.alias("post_minus_pre_negative_rate"),
        negative.z.alias("negative_rate_z_stat"),
        negative.p.alias("negative_rate_p_value_two_sided"),
        supports.alias("supports_h1_directionally"),
        F.when(enough, F.lit(direction)).otherwise(F.lit(too_few)).alias("note"),
    )


def layoffs_frequency_by_period(rows: DataFrame, study: Study) -> DataFrame:
    """H2: share of layoff posts per configured period."""
    table = bucket_agg(
        valid(rows), [], period_buckets(study.period_names),
        lambda cond: {
            "total_posts": total("posts", cond),
            "layoffs_posts": total("posts", cond & _flag(study.layoffs_topic)),
        },
    )
    return table.orderBy("period_ord").select(
        "time_period", "total_posts", "layoffs_posts",
        safe_divide(F.col("layoffs_posts"), F.col("total_posts")).alias("layoffs_share_of_all_posts"),
    )


def layoffs_frequency_test(rows: DataFrame, study: Study) -> DataFrame:
    """H2: share of layoff posts in the last period against all earlier ones."""
    post = F.col("time_period") == study.after_period
    earlier = F.col("time_period").isin(*study.earlier_periods)
    topic = _flag(study.layoffs_topic)
    flat = valid(rows).agg(
        total("posts", post).alias("post_total_posts"),
        total("posts", post & topic).alias("post_layoffs_posts"),
        total("posts", earlier).alias("earlier_total_posts"),
        total("posts", earlier & topic).alias("earlier_layoffs_posts"),
    )
    pn, pk = F.col("post_total_posts"), F.col("post_layoffs_posts")
    en, ek = F.col("earlier_total_posts"), F.col("earlier_layoffs_posts")
    test = two_proportion_z_test(pk, pn, ek, en)
    comparison = f"{study.after_period} vs earlier ({' + '.join(study.earlier_periods)})"
    return flat.select(
        F.lit("H2_frequency").alias("hypothesis"),
        F.lit(comparison).alias("comparison"),
        "post_total_posts", "post_layoffs_posts", safe_divide(pk, pn).alias("post_layoffs_share"),
        "earlier_total_posts", "earlier_layoffs_posts", safe_divide(ek, en).alias("earlier_layoffs_share"),
        test.difference.alias("post_minus_earlier_layoffs_share"),
        test.z.alias("z_stat"),
        test.p.alias("p_value_two_sided"),
        ((pn > 0) & (en > 0) & (safe_divide(pk, pn) > safe_divide(ek, en))).alias(
            "supports_h2_frequency_directionally"
        ),
    )


def layoffs_sentiment_tests(rows: DataFrame, study: Study) -> DataFrame:
    """H2: positive rate of layoff posts against all others, overall and in the last period."""
    topic = _flag(study.layoffs_topic)
    other = F.col(topic_column(study.layoffs_topic)) == 0
    scopes = [
        ({"comparison_scope": "overall"}, F.lit(True)),
        ({"comparison_scope": f"{study.after_period} only"}, F.col("time_period") == study.after_period),
    ]
    table = bucket_agg(
        valid(rows), [], scopes,
        lambda scope: {
            "a_n": total("posts", scope & topic),
            "a_k": total("posts", scope & topic & (F.col("label") == 1)),
            "b_n": total("posts", scope & other),
            "b_k": total("posts", scope & other & (F.col("label") == 1)),
        },
    )
    an, ak, bn, bk = (F.col(c) for c in ("a_n", "a_k", "b_n", "b_k"))
    test = two_proportion_z_test(ak, an, bk, bn)
    return table.select(
        F.lit("H2_sentiment").alias("hypothesis"),
        "comparison_scope",
        an.alias("layoffs_total_posts"),
        safe_divide(ak, an).alias("layoffs_positive_rate"),
        bn.alias("non_layoffs_total_posts"),
        safe_divide(bk, bn).alias("non_layoffs_positive_rate"),
        test.difference.alias("layoffs_minus_non_layoffs_positive_rate"),
        test.z.alias("z_stat"),
        test.p.alias("p_value_two_sided"),
        ((an > 0) & (bn > 0) & (safe_divide(ak, an) < safe_divide(bk, bn))).alias(
            "supports_h2_lower_sentiment_directionally"
        ),
    )


def monthly_ai_sentiment(rows: DataFrame, study: Study) -> DataFrame:
    """H4: AI posts and overall sentiment per observed month."""
    monthly = (
        valid(rows).filter(F.col("year_month") != "").groupBy("year_month")
        .agg(
            *aliased(sentiment_sums()),
            total("posts", _flag(study.ai_topic)).alias("ai_posts"),
            mean_prob("prob_positive").alias("overall_avg_prob_positive"),
            mean_prob("prob_negative").alias("overall_avg_prob_negative"),
        )
    )
    n = F.col("total_posts")
    return monthly.select(
        "year_month", "total_posts", "ai_posts",
        safe_divide(F.col("ai_posts"), n).alias("ai_share_of_all_posts"),
        F.col("positive_posts").alias("overall_positive_posts"),
        F.col("negative_posts").alias("overall_negative_posts"),
        safe_divide(F.col("positive_posts"), n).alias("overall_positive_rate"),
        safe_divide(F.col("negative_posts"), n).alias("overall_negative_rate"),
        "overall_avg_prob_positive", "overall_avg_prob_negative",
    ).orderBy("year_month")


def ai_sentiment_correlation(monthly: DataFrame) -> DataFrame:
    """H4: correlation of the monthly AI share with the two sentiment rates."""
    share = F.col("ai_share_of_all_posts")
    flat = monthly.agg(
        F.count(F.lit(1)).alias("num_months_available"),
        guarded_correlation(share, F.col("overall_positive_rate")).alias("ai_share_vs_overall_positive_rate_corr"),
        guarded_correlation(share, F.col("overall_negative_rate")).alias("ai_share_vs_overall_negative_rate_corr"),
    )
    testable = F.col("num_months_available") >= 2
    return flat.select(
        F.lit("H4").alias("hypothesis"), "*",
        testable.alias("supports_h4_association_testable"),
        F.when(testable, F.lit("Correlation computed across monthly AI share and overall sentiment."))
        .otherwise(F.lit("Correlation requires at least 2 months of data.")).alias("note"),
    )


def hypothesis_readiness(tagged: DataFrame, rows: DataFrame, study: Study) -> DataFrame:
    """Whether the data allows each test, with the counts behind the verdict.

    The author rule is not the one of the author tables: raw spelling, placeholders included.
    """
    recruiting = _flag(study.recruiting_topic)
    in_before = F.col("time_period") == study.before_period
    in_after = F.col("time_period") == study.after_period
    # Summed per (month, period, flags) first, so the distinct count runs over a small table.
    flat = (
        valid(rows).groupBy("year_month")
        .agg(
            total("posts", recruiting & in_before).alias("pre"),
            total("posts", recruiting & in_after).alias("post"),
            total("posts", _flag(study.layoffs_topic)).alias("layoffs"),
        )
        .agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pre", "post", "layoffs")],
            F.count_if(F.col("year_month") != "").alias("months"),
        )
    )
    before, after = study.before_period, study.after_period

    def row(name, question, good, yes, no, note):
        return F.struct(
            F.lit(name).alias("hypothesis"), F.lit(question).alias("question"),
            F.when(good, F.lit(yes)).otherwise(F.lit(no)).alias("status_with_current_data"),
            note.alias("current_result_note"),
        )

    not_yet = "not_fully_testable_with_current_sample"
    from_posts = flat.select(F.inline(F.array(
        row("H1", f"Recruiting sentiment is more negative in {after} than {before}.",
            (F.col("pre") > 0) & (F.col("post") > 0), "ready_for_real_test", not_yet,
            F.format_string(f"{before} recruiting posts=%d, {after} recruiting posts=%d", "pre", "post")),
        row("H2", "Layoff-related posts increase after 2022 and have lower sentiment.",
            F.col("layoffs") > 0, "partially_testable", "not_observable_in_current_sample",
            F.format_string("layoffs-topic posts in current dataset=%d", "layoffs")),
        row("H4", "AI-topic prevalence over time is associated with overall sentiment shifts.",
            F.col("months") >= 2, "ready_for_real_test", not_yet,
            F.format_string("distinct months in dataset=%d", "months")),
    )))
    named = tagged.filter(
        numeric_column(tagged, "predicted_label", coerce_label).isNotNull() & (normalize_text(F.col("author")) != "")
    )
    least = study.min_user_posts
    users = (
        named.groupBy("author").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") >= least).alias("users"))
    )
    from_users = users.select(F.inline(F.array(
        row("H3", "User-level sentiment differs by topic and produces cross-topic correlations.",
            F.col("users") > 0, "partially_testable", not_yet,
            F.format_string(f"eligible users with >={least} posts=%d", "users")),
    )))
    return from_posts.unionByName(from_users).orderBy("hypothesis")
