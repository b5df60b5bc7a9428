from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from moodtide.operators import features, models
from moodtide.plans.training_plan import fit_both
from moodtide.session import durable
from moodtide.sources.artifacts import read_model, write_model

WORDS = ["good", "great", "bad", "awful", "the", "a", "job", "offer", "x", "market"]


def corpus(n=400, seed=5):
    """Separable text: the first words lean to one class each."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = int(rng.random() < 0.6)
        lean = WORDS[:2] if label else WORDS[2:4]
        words = [rng.choice(lean if rng.random() < 0.4 else WORDS) for _ in range(rng.randrange(1, 30))]
        rows.append((str(i), label, " ".join(words)))
    return rows


@pytest.fixture(scope="module")
def labeled(spark):
    return spark.createDataFrame(corpus(), "id string, label int, cleaned_text string").repartition(4).cache()


def test_term_counts(spark):
    docs = spark.createDataFrame([("1", "b a bb bb cc b bb"), ("2", ""), ("3", None), ("4", "x y")], "id string, cleaned_text string")
    got = {(r["id"], r["term"]): r["tf"] for r in features.term_counts(docs).collect()}
    assert got == {("1", "bb"): 3, ("1", "cc"): 1}
    assert docs.select(features.tokenize(F.col("cleaned_text"))).first()[0] == ["bb", "bb", "cc", "bb"]


def test_weights_against_direct_computation(spark, labeled):
    terms = features.term_counts(labeled)
    vocabulary = features.vocabulary_topn(features.document_frequency(terms, labeled), 6)
    texts = {i: [w for w in t.split() if len(w) >= 2] for i, _, t in corpus()}
    total, df = Counter(), Counter()
    for words in texts.values():
        total.update(words)
        df.update(set(words))
    keep = [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:6]]
    idf = {w: math.log((1 + len(texts)) / (1 + df[w])) + 1 for w in keep}
    got = {(r["id"], r["term"]): r["weight"] for r in features.tfidf_weights(terms, vocabulary).collect()}
    want = {}
    for i, words in texts.items():
        w = {t: (1 + math.log(c)) * idf[t] for t, c in Counter(words).items() if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        want.update({(i, t): v / norm for t, v in w.items()})
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("limit", [1, 3, 7, 40, 100])
def test_vocabulary_is_the_exact_top(spark, limit):
    freq = [(f"t{i:02}", 1, f) for i, f in enumerate([1] * 20 + [2] * 10 + [3, 4, 4, 7, 8, 8, 9, 16, 1000, 2**40])]
    df = spark.createDataFrame(freq, "term string, doc_freq long, corpus_freq long").repartition(4)
    want = [t for t, _, _ in sorted(freq, key=lambda r: (-r[2], r[0]))[:limit]]
    assert [r["term"] for r in features.vocabulary_topn(df, limit).collect()] == want


@pytest.mark.parametrize("sizes", [(100, 100), (3, 998), (7, 6), (1, 0), (50, 13)])
def test_split_is_exact_and_repeatable(spark, sizes):
    rows = [(f"{label}-{i}", label) for label, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, label int")
    split = models.stratified_split(df)
    n_test = -(-sum(sizes) // 5)
    counts = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert sum(n for (_, s), n in counts.items() if s == "test") == n_test
    for label, n in enumerate(sizes):
        assert abs(counts.get((label, "test"), 0) - n_test * n / sum(sizes)) < 1
    assert split.exceptAll(models.stratified_split(df.repartition(3))).count() == 0


def test_split_with_a_repeated_key(spark):
    rows = [("same", 1)] * 300 + [(str(i), 1) for i in range(600)] + [(f"n{i}", 0) for i in range(100)]
    split = models.stratified_split(spark.createDataFrame(rows, "id string, label int").repartition(6))
    assert split.filter("id = 'same'").select("split").distinct().count() == 1
    assert split.count() == 1000 and split.filter("split = 'test'").count() >= 200


def test_split_ranks_no_rows(spark, labeled):
    from moodtide.operators.models import stratified_split

    text = stratified_split(labeled)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert windows and not any("cleaned_text" in line for line in windows)


def test_models_learn_and_store(spark, labeled, tmp_path):
    trained = fit_both(labeled, 8)
    metrics = {r["model"]: r for r in trained.selection.collect()}
    majority = max(Counter(label for _, label, _ in corpus()).values()) / 400
    assert all(m["accuracy"] > majority + 0.05 for m in metrics.values())
    assert sum(m["selected"] for m in metrics.values()) == 1
    for name, model in (("lr", trained.logistic_regression), ("nb", trained.naive_bayes)):
        write_model(model, str(tmp_path / name))
        back = read_model(spark, str(tmp_path / name))
        assert back.filter("term IS NULL").count() == 1 and back.count() == 9
        coefficient = {r["term"]: r["coefficient"] for r in back.collect()}
        assert coefficient["good"] > 0 > coefficient["awful"]


def test_vectors_tell_rows_of_one_key_apart(spark):
    """One text labelled both ways is two documents."""
    docs = spark.createDataFrame([("1", 0, "aa bb aa"), ("1", 1, "aa bb aa"), ("2", 1, "zz")], "id string, label int, cleaned_text string")
    vocabulary = spark.createDataFrame([("aa", 1.0, 0), ("bb", 1.0, 1)], "term string, idf double, idx int")
    rows = features.document_vectors(docs, vocabulary).orderBy("id", "label").collect()
    lengths = [sum(e["weight"] ** 2 for e in r["entries"]) for r in rows]
    assert lengths == [pytest.approx(1.0), pytest.approx(1.0), 0]


def test_rows_of_one_key_are_scored_and_fitted_one_by_one(spark, labeled):
    model = spark.createDataFrame([("good", 1.0, 2.0), ("bad", 1.0, -2.0), (None, None, 0.0)], "term string, idf double, coefficient double")
    docs = spark.createDataFrame([("1", "good"), ("1", "good"), ("1", "bad good"), ("1", "bad")], "id string, cleaned_text string")
    scores = sorted(round(r["prob_positive"], 6) for r in models.predict_sentiment(docs, model).collect())
    high = round(1 / (1 + math.exp(-2)), 6)
    assert scores == [round(1 - high, 6), 0.5, high, high]
    weights = features.tfidf_weights(features.term_counts(docs), model.filter("term IS NOT NULL")).collect()
    assert len(weights) == 5 and sum(r["weight"] == 1.0 for r in weights) == 3
    twice = labeled.unionByName(labeled)
    vocabulary = durable(models.fit_vocabulary(twice))
    vectors = durable(features.document_vectors(twice, vocabulary))
    assert vectors.count() == 2 * labeled.count()
    fitted = durable(models.train_logistic_regression(vectors, vocabulary))
    gradient = models.logistic_regression_gradient(vectors, vocabulary, fitted).collect()
    assert len(gradient) == fitted.count() and all(abs(r["gradient"]) < 0.01 for r in gradient)


def test_unknown_words_still_get_a_prediction(spark):
    model = spark.createDataFrame([("good", 1.0, 2.0), (None, None, -0.5)], "term string, idf double, coefficient double")
    docs = spark.createDataFrame([("1", "good good"), ("2", "zz yy"), ("3", "a"), ("4", "")], "id string, cleaned_text string")
    rows = {r["id"]: r for r in models.predict_sentiment(docs, model).collect()}
    assert [rows[i]["predicted_label"] for i in "1234"] == [1, 0, 0, 0]
    assert rows["1"]["prob_positive"] == pytest.approx(1 / (1 + math.exp(-1.5)))
    assert rows["2"]["prob_positive"] == pytest.approx(1 / (1 + math.exp(0.5)))
    assert all(r["prob_negative"] + r["prob_positive"] == pytest.approx(1.0) for r in rows.values())


def test_kept_columns_ride_along(spark):
    model = spark.createDataFrame([("good", 1.0, 2.0), (None, None, 0.0)], "term string, idf double, coefficient double")
    docs = spark.createDataFrame([("1", "good", "jobs"), ("2", "", None)], "id string, cleaned_text string, subreddit string")
    out = models.predict_sentiment(docs, model, keep=("subreddit",))
    assert [(r["id"], r["subreddit"], r["predicted_sentiment"]) for r in out.orderBy("id").collect()] == [
        ("1", "jobs", "positive"), ("2", None, "negative"),
    ]
    wide = models.attach_predictions(docs, models.predict_sentiment(docs, model))
    assert wide.count() == 2 and "cleaned_text" in wide.columns


def test_logistic_regression_minimises_its_objective(spark, labeled):
    """Moving any coefficient of the fitted model must not lower the stated objective."""
    vocabulary = models.fit_vocabulary(labeled, 6)
    vectors = features.document_vectors(labeled, vocabulary)
    assert vectors.count() == labeled.count()
    model = {r["term"]: r["coefficient"] for r in models.train_logistic_regression(vectors, vocabulary).collect()}
    weights = features.tfidf_weights(features.term_counts(labeled), vocabulary).collect()
    docs = {i: ({}, 1 if label else -1) for i, label, _ in corpus()}
    for r in weights:
        docs[r["id"]][0][r["term"]] = r["weight"]

    def objective(m):
        loss = sum(math.log1p(math.exp(-y * (m[None] + sum(m[t] * w for t, w in x.items())))) for x, y in docs.values())
        return 0.5 * sum(c * c for t, c in m.items() if t is not None) + loss

    best = objective(model)
    for term in model:
        for step in (0.05, -0.05):
            assert objective({**model, term: model[term] + step}) > best


def test_metrics_by_hand(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 9 + [(1, 0)] * 4
    scored = spark.createDataFrame(rows, "label int, predicted_label int")
    assert [tuple(r) for r in models.confusion_matrix(scored).orderBy("label").collect()] == [(0, 5, 2), (1, 4, 9)]
    m = {r["scope"]: r for r in models.classification_metrics(scored).collect()}
    assert m["positive"]["precision"] == pytest.approx(9 / 11) and m["positive"]["recall"] == pytest.approx(9 / 13)
    assert m["negative"]["f1"] == pytest.approx(10 / 16) and m["macro avg"]["accuracy"] == pytest.approx(0.7)
    assert m["weighted avg"]["support"] == 20


def test_a_tie_goes_to_the_default_model(spark):
    scored = spark.createDataFrame([(0, 0), (1, 1), (1, 0)], "label int, predicted_label int")
    rows = models.model_selection({"logistic_regression": scored, "naive_bayes": scored}).collect()
    assert [r["model"] for r in rows if r["selected"]] == ["logistic_regression"]
