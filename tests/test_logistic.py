"""The search for the coefficients of logistic regression."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodtide.operators import features, logistic, models
from moodtide.session import durable

VECTORS = "label int, entries array<struct<idx:int,weight:double>>"


def skewed(n=1200, terms=3000, seed=3):
    """Texts of a few very common and many rare words, with more than four in five of one class."""
    rng = random.Random(seed)
    words = ["w" + "".join(chr(97 + int(d)) for d in str(i)) for i in range(terms)]
    weights = [1.0 / (i + 1) for i in range(terms)]
    rows = []
    for i in range(n):
        text = rng.choices(words, weights, k=rng.randrange(5, 150))
        rows.append((str(i), int(rng.random() < 0.86 or words[3] in text), " ".join(text)))
    return rows


def test_the_search_takes_few_passes(spark):
    docs = spark.createDataFrame(skewed(), "id string, label int, cleaned_text string").repartition(4)
    vocabulary = durable(models.fit_vocabulary(docs))
    vectors = durable(features.document_vectors(docs, vocabulary))
    context = spark.sparkContext
    context.setJobGroup("fit", "logistic regression")
    try:
        model = durable(models.train_logistic_regression(vectors, vocabulary))
        jobs = len(context.statusTracker().getJobIdsForGroup("fit"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    gradient = models.logistic_regression_gradient(vectors, vocabulary, model)
    assert gradient.agg(F.max(F.abs("gradient"))).first()[0] <= logistic.MAX_SLOPE
    assert model.count() == vocabulary.count() + 1 and jobs < 60


def test_slopes_against_direct_sums(spark):
    rows = [(1, [(0, 0.6), (2, 0.8)]), (0, []), (0, [(1, 1.0)]), (1, [(2, 1.0)]), (1, []), (0, [(0, 0.8), (1, 0.6)])] * 3
    at = np.array([0.5, -1.5, 2.0, 0.25])
    want, loss = np.zeros(4), 0.0
    for label, entries in rows:
        margin = at[3] + sum(at[i] * w for i, w in entries)
        loss += math.log1p(math.exp(-margin if label else margin))
        for i, w in [*entries, (3, 1.0)]:
            want[i] += w * (1.0 / (1.0 + math.exp(-margin)) - label)
    for parts in (1, 3, 40):
        blocks = logistic.row_blocks(spark.createDataFrame(rows, VECTORS).repartition(parts))
        assert logistic._loss(blocks, at) == pytest.approx([*want, loss])


def test_blocks_are_bounded_and_hold_every_row(monkeypatch):
    monkeypatch.setattr(logistic, "BLOCK_ENTRIES", 4)
    idx = [[0], [], [1, 2, 3], [4], [], [0, 1, 2, 3, 4, 5], [], [7]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([float(i) for i in range(8)]), pa.array(idx, pa.list_(pa.int32())),
         pa.array([[i / 8 for i in row] for row in idx], pa.list_(pa.float64()))], ["label", "idx", "weight"],
    )
    got, most = [], 0
    for block in logistic._packed([batch.slice(0, 3), batch.slice(3)]):
        labels, lengths, indices, weight = logistic._arrays(tuple(block.to_pylist()[0].values()))
        assert logistic._row_sums(weight, lengths) == pytest.approx([sum(idx[int(label)]) / 8 for label in labels])
        most = max(most, sum(lengths > 0) > 1 and len(indices))
        ends = np.cumsum(lengths)
        got += [(label, list(indices[e - n:e])) for label, n, e in zip(labels, lengths, ends)]
    assert got == list(enumerate(idx)) and most <= 4


def test_rows_of_one_class_and_no_rows(spark):
    one = spark.createDataFrame([(1, [(0, 1.0)]), (1, [])], VECTORS)
    fitted, bias = logistic.fit(one, 2, 1.0, 10, 1e-10)
    assert list(fitted) == [0.0, 0.0] and bias == math.inf
    assert logistic.fit(one.withColumn("label", F.lit(0)), 2, 1.0, 10, 1e-10)[1] == -math.inf
    none = spark.createDataFrame([(1, []), (0, []), (1, [])], VECTORS)
    fitted, bias = logistic.fit(none, 0, 1.0, 10, 1e-10)
    assert len(fitted) == 0 and bias == pytest.approx(math.log(2.0))
    for wrong in (one.limit(0), none.withColumn("label", F.col("label") + 1), none.withColumn("label", F.lit(None).cast("int"))):
        with pytest.raises(ValueError):
            logistic.fit(wrong, 2, 1.0, 10, 1e-10)
    with pytest.warns(UserWarning):
        logistic.fit(spark.createDataFrame([(1, [(0, 1.0)]), (0, [(1, 1.0)]), (1, [(1, 1.0)])], VECTORS), 2, 1.0, 1, 1e-10)
