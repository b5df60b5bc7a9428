"""A stored sentiment model as a stage of ``pyspark.ml``, saved and loaded with the pipeline it is part of."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame

from moodtide.operators.models import predict_sentiment
from moodtide.session import durable
from moodtide.sources.artifacts import read_model, write_model


class SentimentStage(Transformer, MLReadable, MLWritable):
    """``predict_sentiment`` with its model table (term, idf, coefficient) and column names.

    The result has the key, the kept columns and the predictions, a row per row of the input, repeated and
    missing keys included. Missing and empty texts score the intercept alone.
    """

    keyCol = Param(Params._dummy(), "keyCol", "the document's key", TypeConverters.toString)
    textCol = Param(Params._dummy(), "textCol", "cleaned text", TypeConverters.toString)
    keepCols = Param(Params._dummy(), "keepCols", "narrow columns to keep", TypeConverters.toListString)

    def __init__(self, model: DataFrame | None = None, key: str = "id", text: str = "cleaned_text", keep: tuple[str, ...] = ()):
        super().__init__()
        self._model = model
        self._set(keyCol=key, textCol=text, keepCols=list(keep))

    @property
    def model(self) -> DataFrame:
        if self._model is None:
            raise ValueError("the stage has no model yet")
        return self._model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = [self.getOrDefault(p) for p in (self.keyCol, self.textCol, self.keepCols)]
        return predict_sentiment(dataset, self.model, names[0], names[1], tuple(names[2]))

    def write(self) -> MLWriter:
        return _StageWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StageReader()

    @classmethod
    def of(cls, model: DataFrame, **columns) -> SentimentStage:
        """A stage with a model that is written first, so that scoring knows its size."""
        return cls(durable(model), **columns)


class _StageWriter(MLWriter):
    def __init__(self, stage: SentimentStage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        write_model(self.stage.model, f"{path}/model")


class _StageReader(MLReader):
    def load(self, path: str) -> SentimentStage:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = SentimentStage(read_model(self.sparkSession, f"{path}/model"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage
