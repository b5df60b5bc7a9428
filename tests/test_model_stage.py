"""A sentiment model as a stage of a stored pipeline."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel

from moodtide.operators.model_stage import SentimentStage
from moodtide.operators.models import predict_sentiment
from moodtide.session import durable

_MODEL = [("good", 1.2, 2.0), ("bad", 1.5, -3.0), ("fine", 2.0, 0.5), (None, None, 0.25)]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_loaded_pipeline_scores_alike(spark, tmp_path):
    model = durable(spark.createDataFrame(_MODEL, "term string, idf double, coefficient double"))
    docs = spark.createDataFrame(
        [("a", "good good bad", "x"), ("a", "good", "y"), (None, "fine words", None), ("b", "", "x"), ("c", None, "x")],
        "post string, clean string, grp string",
    )
    stage = SentimentStage.of(model, key="post", text="clean", keep=("grp",))
    expected = _rows(predict_sentiment(docs, model, "post", "clean", ("grp",)))
    assert _rows(stage.transform(docs)) == expected and len(expected) == 5
    path = str(tmp_path / "pipeline")
    PipelineModel([stage]).save(path)
    loaded = PipelineModel.load(path)
    assert loaded.stages[0].uid == stage.uid
    assert _rows(loaded.transform(docs)) == expected and loaded.transform(docs.limit(0)).count() == 0
    PipelineModel([stage]).write().overwrite().save(path)
    assert _rows(PipelineModel.load(path).transform(docs)) == expected


def test_a_stage_without_a_model(spark, tmp_path):
    with pytest.raises(ValueError):
        SentimentStage().transform(spark.range(1))
    with pytest.raises(ValueError):
        SentimentStage().save(str(tmp_path / "stage"))
