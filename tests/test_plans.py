"""What the physical plans must and must not contain."""

from __future__ import annotations

from moodtide.catalog import fixtures as fx
from moodtide.catalog import queries
from moodtide.catalog.fixtures import STUDY
from moodtide.operators import features, models, sentiment
from moodtide.plans.report_plan import report_tables
from moodtide.session import durable, numbered, shared_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_tables_do_not_touch_the_posts(spark, sf_dir):
    tables = report_tables(fx.tagged(spark, sf_dir), STUDY)
    for name, table in tables.items():
        text = plan(table)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "Python" not in text, name
        if name != "hypothesis_overview_table":
            assert "documents.parquet" not in text, name


def test_topic_table_plan(spark, sf_dir):
    text = plan(sentiment.topic_sentiment_table(fx.rows(spark, sf_dir), STUDY))
    assert text.count("documents.parquet") == 1
    assert "Expand" not in text and "NestedLoop" not in text
    assert "partial_sum" in text


def test_flags_need_no_second_search(spark, sf_dir):
    tagged = fx.tagged(spark, sf_dir, for_filter=True).filter("topic_alpha = 1 AND has_any_topic = 1")
    text = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("array_intersect") == 1 and text.count("translate(lower(") == 1


def test_scoring_plan(spark, sf_dir):
    model = spark.createDataFrame([("good", 1.0, 2.0), (None, None, 0.0)], "term string, idf double, coefficient double")
    docs = fx.cleaned_docs(spark, sf_dir)
    text = plan(models.predict_sentiment(docs, durable(model)))
    # The only exchange by document carries two partial sums, not text or terms.
    by_row = [line for line in text.splitlines() if "Exchange hashpartitioning(id" in line and "_row" in line]
    assert len(by_row) == 1 and "Window" not in text and "SortMergeJoin" not in text and "Python" not in text


def test_scans_read_only_what_is_needed(spark, sf_dir):
    text = plan(sentiment.group_sentiment_table(fx.rows(spark, sf_dir)))
    schemas = [line.split("ReadSchema: ")[1] for line in text.splitlines() if "ReadSchema" in line]
    assert not any("o_totalprice" in s or "lang" in s or "toxic" in s or "n_chars" in s for s in schemas)


def test_training_runs_no_python_and_no_window_over_the_vocabulary(spark, sf_dir):
    rows = fx.labeled_docs(spark, sf_dir)
    vocabulary = durable(models.fit_vocabulary(rows))
    vectors = features.document_vectors(rows, vocabulary)
    bayes = models.train_naive_bayes(durable(vectors), vocabulary)
    for frame in (vectors, models.vector_table(vectors, vocabulary.count()), bayes):
        assert "Python" not in plan(frame) and "Window" not in plan(frame)


def test_intermediate_tables_are_in_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    table = durable(spark.range(5))
    assert all(named in f for f in table.inputFiles())
    places = numbered(spark.range(0, 50, 1, 7).orderBy("id"), "place").collect()
    assert sorted((r["id"], r["place"]) for r in places) == [(i, i) for i in range(50)]


def test_texts_are_cleaned_and_counted_once(spark, sf_dir):
    weights = plan(queries.QUERIES["tfidf_weights"](spark, sf_dir))
    assert "Generate" not in weights and "documents.parquet" not in weights
    scored = plan(queries.QUERIES["predict_sentiment"](spark, sf_dir))
    assert "translate(" not in scored and "documents.parquet" not in scored
