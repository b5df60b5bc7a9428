"""Labelled text to two stored models and their evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.operators.features import MAX_FEATURES, document_vectors
from moodtide.operators.models import (
    apply_split, class_log_prior, fit_vocabulary, model_selection, naive_bayes_model, predict_sentiment,
    split_thresholds, train_logistic_regression, train_naive_bayes,
)
from moodtide.session import durable


@dataclass(frozen=True)
class Trained:
    logistic_regression: DataFrame
    naive_bayes: DataFrame
    test: DataFrame
    selection: DataFrame


def fit_both(labeled: DataFrame, max_features: int = MAX_FEATURES) -> Trained:
    """Split, fit both models on the training part and compare them on the rest.

    Cleaned rows, split thresholds, vocabulary and document vectors are written once: both fits
    read them several times, and the thresholds need only two of the columns.
    """
    rows = durable(labeled)
    split = apply_split(rows, durable(split_thresholds(rows)))
    train, test = (split.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    vocabulary = durable(fit_vocabulary(train, max_features))
    vectors = durable(document_vectors(train, vocabulary))
    bayes = durable(naive_bayes_model(train_naive_bayes(vectors, vocabulary), class_log_prior(train)))
    logistic = durable(train_logistic_regression(vectors, vocabulary))
    scored = {
        name: predict_sentiment(test, model, keep=("label",))
        for name, model in (("logistic_regression", logistic), ("naive_bayes", bayes))
    }
    return Trained(logistic, bayes, test, model_selection(scored))
