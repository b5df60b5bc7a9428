"""The report cube kept up to date batch by batch, so that a new dump does not mean reading the old ones again.

The cube's measures are sums, so the cubes of any batches together are a cube: each batch's is stored below its
name, by month, and the table operators sum over whatever they are given. A late post counts in its own month,
whichever batch brings it. A batch that is put again replaces itself.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.config import Study
from moodtide.operators.measures import MEASURES, measured, report_cube

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


class CubeStore:
    """Cubes of one study below a folder that all executors share, as ``batch=<name>/month=<YYYY-MM>`` Parquet."""

    def __init__(self, spark: SparkSession, path: str, study: Study):
        self.spark, self.path, self.study = spark, path.rstrip("/"), study
        dims = ["subreddit string", "year_month string", "time_period string", "label int", "has_any_topic int"]
        sums = [f"{m} {'double' if m.endswith('_sum') else 'bigint'}" for m in MEASURES]
        self._columns = ", ".join([*dims, *[f"`{c}` int" for c in study.topic_columns], *sums])
        system, folder = _folder(spark, self.path)
        system.mkdirs(folder)

    def put(self, batch: str, tagged: DataFrame) -> None:
        """Store the cube of a batch of tagged posts, in place of what the batch held before.

        An empty batch holds nothing. Names are letters, digits, ``_``, ``.`` and ``-``. Do not read the store
        while a batch is being replaced.
        """
        if not _NAME.fullmatch(batch):
            raise ValueError(f"not a batch name: {batch!r}")
        cube = report_cube(measured(tagged, self.study), self.study)
        typed = self.spark.createDataFrame([], self._columns).schema
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in typed]
        dealt = cube.select(*columns, F.col("year_month").alias("month")).hint("rebalance", "month")
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("month")
        writer.parquet(f"{self.path}/batch={batch}")

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(f"{self._columns}, batch string, month string").parquet(self.path)

    def batches(self) -> DataFrame:
        """Posts of each batch and month that has any."""
        return self._stored().groupBy("batch", "year_month").agg(F.sum("posts").alias("posts"))

    def cube(self, first_month: str | None = None, last_month: str | None = None) -> DataFrame:
        """The cube of all batches, or of a span of months, whose folders alone are then read."""
        rows = self._stored()
        if first_month is not None:
            rows = rows.filter(F.col("month") >= first_month)
        if last_month is not None:
            rows = rows.filter(F.col("month") <= last_month)
        return report_cube(rows.drop("batch", "month"), self.study)
