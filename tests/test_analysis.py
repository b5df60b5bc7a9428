from __future__ import annotations

import csv
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from moodtide.catalog import fixtures as fx
from moodtide.catalog.fixtures import STUDY
from moodtide.operators import hypotheses, sentiment, tagging, trends, users
from moodtide.operators.measures import measured, report_cube
from moodtide.plans.report_plan import write_report


@pytest.fixture(scope="module")
def tagged(spark, sf_dir):
    df = fx.tagged(spark, sf_dir).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def rows(tagged):
    return measured(tagged, STUDY)


@pytest.fixture(scope="module")
def cube(rows):
    df = report_cube(rows, STUDY).cache()
    yield df
    df.unpersist()


def as_rows(df):
    return sorted(
        tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.fillna(-1.0).collect()
    )


TABLES = {
    "overall": lambda r: sentiment.overall_summary(r),
    "period": lambda r: sentiment.period_sentiment_table(r, STUDY),
    "group": lambda r: sentiment.group_sentiment_table(r),
    "month": lambda r: sentiment.monthly_sentiment_table(r),
    "topic": lambda r: sentiment.topic_sentiment_table(r, STUDY),
    "summary": lambda r: sentiment.topic_sentiment_summary(r, STUDY),
    "topic month": lambda r: sentiment.topic_monthly_table(r, STUDY),
    "trend": lambda r: trends.topic_monthly_trends_long(r, STUDY),
    "period topic": lambda r: trends.topic_period_summary(r, STUDY),
    "group month": lambda r: trends.topic_group_monthly_trends(r, STUDY),
    "h1": lambda r: hypotheses.recruiting_proportion_test(r, STUDY),
    "h2": lambda r: hypotheses.layoffs_sentiment_tests(r, STUDY),
    "h4": lambda r: hypotheses.monthly_ai_sentiment(r, STUDY),
}


@pytest.mark.parametrize("name", list(TABLES))
def test_cube_gives_the_same_table_as_the_rows(rows, cube, name):
    assert as_rows(TABLES[name](rows)) == as_rows(TABLES[name](cube))


def sums(df, *columns):
    return df.agg(*[F.sum(c) for c in columns]).first()[:]


def test_tables_agree_on_totals(cube):
    columns = ("total_posts", "positive_posts", "negative_posts")
    month = sentiment.monthly_sentiment_table(cube)
    period = sentiment.period_sentiment_table(cube, STUDY)
    want = sentiment.overall_summary(cube).select(*columns).first()[:]
    for table in (month, period, sentiment.group_sentiment_table(cube)):
        assert sums(table, *columns) == want
        assert table.filter((F.col("total_posts") > 0) & (F.abs(F.col("positive_rate") + F.col("negative_rate") - 1) > 1e-12)).count() == 0
    assert sums(month, "posts_with_any_topic") == sums(period, "posts_with_any_topic")
    topics = sentiment.topic_sentiment_table(cube, STUDY)
    assert sums(topics, "total_posts")[0] >= sums(month, "posts_with_any_topic")[0]


def test_months_regroup_to_periods(cube):
    month = sentiment.monthly_sentiment_table(cube).withColumn("y", F.substring("year_month", 1, 4).cast("int"))
    period = F.when(F.col("y") <= 1996, "early").when(F.col("y") <= 1998, "mid").otherwise("late").alias("time_period")
    regrouped = month.groupBy(period).agg(F.sum("total_posts").alias("n"), F.sum("positive_posts").alias("p"))
    direct = sentiment.period_sentiment_table(cube, STUDY).select("time_period", "total_posts", "positive_posts")
    assert as_rows(regrouped) == as_rows(direct)


def month_rows(spark, counts):
    data = [(m, "g", "p", 1, int(a), int(a), 0, 0, 0) for m, n, k in counts for a in [True] * k + [False] * (n - k)]
    names = ["year_month", "subreddit", "time_period", "predicted_label", "has_any_topic", *STUDY.topic_columns]
    return measured(spark.createDataFrame(data, names), STUDY)


def test_gap_months_and_blank_months(spark):
    r = month_rows(spark, [("2020-11", 2, 1), ("2021-02", 1, 1), ("", 3, 0), (" ", 1, 0)])
    totals = trends.monthly_post_totals(r, STUDY).collect()
    assert [tuple(t) for t in totals] == [
        ("2020-11", 2, 1), ("2020-12", 0, 0), ("2021-01", 0, 0), ("2021-02", 1, 1),
    ]
    assert [t[0] for t in trends.full_month_index(r).collect()] == [t[0] for t in totals]
    blank = trends.topic_group_monthly_trends(r, STUDY).filter("year_month = '' AND topic_bucket = 'alpha'").first()
    assert blank["total_posts_in_month_subreddit"] == 4


def test_indexed_trend_edges(spark):
    r = month_rows(spark, [("2020-01", 2, 0), ("2020-02", 4, 2), ("2020-03", 9, 3)])
    indexed = sentiment.indexed_topic_trend(sentiment.topic_monthly_table(r, STUDY)).collect()
    assert [i["indexed_count"] for i in indexed if i["topic_bucket"] == "alpha"] == [0.0, 100.0, 150.0]
    assert {i["indexed_count"] for i in indexed if i["topic_bucket"] == "none"} == {0.0}


def test_unlabelled_data_gives_zero_tables(spark, tagged):
    empty = measured(tagged.withColumn("predicted_label", F.lit(7)), STUDY)
    assert sentiment.overall_summary(empty).first()["total_posts"] == 0
    topics = sentiment.topic_sentiment_table(empty, STUDY).collect()
    assert len(topics) == 4 and all(t["positive_rate_minus_overall"] is None for t in topics)
    h1 = hypotheses.recruiting_proportion_test(empty, STUDY).first()
    assert h1["positive_rate_z_stat"] is None and not h1["supports_h1_directionally"] and h1["note"].startswith("Insufficient")
    assert hypotheses.ai_sentiment_correlation(hypotheses.monthly_ai_sentiment(empty, STUDY)).first()["num_months_available"] == 0


def author_posts(spark, n=4000, seed=3):
    """A third of all posts by one author, the rest spread thinly."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        author = "Whale" if i % 3 == 0 else f"user{rng.randrange(900)}"
        flags = [int(rng.random() < p) for p in (0.5, 0.4, 0.3, 0.0)]
        data.append((str(i), author, rng.randrange(2), *flags))
    names = ["id", "author", "predicted_label", *STUDY.topic_columns]
    return spark.createDataFrame(data, names).repartition(5), data


def test_author_tables_against_brute_force(spark):
    df, data = author_posts(spark)
    posts = users.authored(df, STUDY)
    authors = users.author_topics(posts, STUDY)
    by_author = Counter(r[1].lower() for r in data)
    eligible = {a for a, n in by_author.items() if n >= 3}
    cells = defaultdict(list)
    for r in data:
        if r[1].lower() in eligible:
            for t, flag in zip(STUDY.topic_names, r[3:]):
                if flag:
                    cells[r[1].lower(), t].append(r[2])
    got = {(r["author_norm"], r["topic_bucket"]): (r["posts_in_topic"], r["avg_predicted_label"])
           for r in users.user_topic_sentiment_long(authors, STUDY).collect()}
    assert got == {k: (len(v), sum(v) / len(v)) for k, v in cells.items()}
    summary = users.user_summary(authors, STUDY).first()
    assert summary["eligible_users"] == len(eligible) and summary["user_topic_rows"] == len(cells)

    import pandas as pd

    wide = pd.DataFrame([(a, t, sum(v) / len(v)) for (a, t), v in cells.items()], columns=["a", "t", "x"])
    want = wide.pivot(index="a", columns="t", values="x").corr(min_periods=2)
    matrix = {(r["topic_a"], r["topic_b"]): r["correlation"] for r in users.topic_correlation_matrix(authors, STUDY).collect()}
    assert set(matrix) == {(a, b) for a in want.columns for b in want.columns}
    assert all(matrix[a, b] == pytest.approx(want.loc[a, b], abs=1e-9) for a, b in matrix)


def test_semi_join_with_a_hot_author(spark):
    df, data = author_posts(spark)
    rows = df.withColumn("author_norm", F.lower("author"))
    counts = Counter(r[1].lower() for r in data)
    want = sorted(r[0] for r in data if counts[r[1].lower()] >= 4)
    assert sorted(r["id"] for r in users.semi_join_eligible_authors(rows, 4).select("id").collect()) == want


def test_report_is_written(spark, tagged, tmp_path):
    names = write_report(tagged, STUDY, str(tmp_path))
    assert len(names) == 32
    (part,) = [p for p in (tmp_path / "topic_sentiment_table").glob("*.csv")]
    with open(part, newline="", encoding="utf-8") as f:
        table = list(csv.DictReader(f))
    assert [r["topic_bucket"] for r in table] == [
        r["topic_bucket"] for r in sentiment.topic_sentiment_table(measured(tagged, STUDY), STUDY).collect()
    ]


def test_partitioned_stage(spark, tagged, tmp_path):
    from moodtide.sources.artifacts import write_partitioned_posts

    path = str(tmp_path / "stage")
    write_partitioned_posts(tagged, path)
    back = spark.read.parquet(path)
    assert back.count() == tagged.count()
    pruned = back.filter("year_month = '1996-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in pruned


def test_topic_definitions(spark, tmp_path):
    from moodtide.sources.artifacts import read_topic_definitions, write_topic_definitions

    write_topic_definitions(tagging.topic_definitions(spark, STUDY), str(tmp_path / "t"))
    rows = read_topic_definitions(spark, str(tmp_path / "t")).collect()
    assert [(r[0], tuple(r[2])) for r in rows] == [(t.name, t.keywords) for t in STUDY.topics]


def test_correlations_of_sixty_topics(spark):
    """Many topics, most missing for most authors, some pairs without a common author, one topic without any."""
    import random

    import pandas as pd

    from moodtide.config import Study, Topic

    study = Study(topics=tuple(Topic(f"t{i:02d}", "d", (f"w{i}",)) for i in range(60)))
    chooser, rows = random.Random(5), []
    for a in range(150):
        mine = set(chooser.sample(range(60), chooser.randint(0, 12))) - {7}
        counts = [chooser.randint(1, 5) if t in mine else 0 for t in range(60)]
        rows.append((f"a{a}", *counts, *[chooser.randint(0, n) if n else None for n in counts]))
    names = ", ".join(["author_norm string", *[f"n{i} bigint" for i in range(60)], *[f"l{i} bigint" for i in range(60)]])
    authors = spark.createDataFrame(rows, names)
    frame = pd.DataFrame([[r[61 + t] / r[1 + t] if r[1 + t] else None for t in range(60)] for r in rows], columns=study.topic_names)
    used = [c for c in frame if frame[c].notna().any()]
    want = frame[used].astype(float).corr(min_periods=2)
    matrix = {(r[0], r[1]): r[2] for r in users.topic_correlation_matrix(authors, study).collect()}
    assert set(matrix) == {(a, b) for a in used for b in used} and len(used) == 59
    for (a, b), value in matrix.items():
        expected = want.loc[a, b]
        assert value is None if pd.isna(expected) else value == pytest.approx(expected, abs=1e-9)
    largest = max(abs(want.loc[a, b]) for a in used for b in used if a != b and not pd.isna(want.loc[a, b]))
    assert users.user_summary(authors, study).first()["max_abs_topic_correlation"] == pytest.approx(largest, abs=1e-9)
    text = users.topic_correlation_matrix(authors, study)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and text.count("Scan") == 1
