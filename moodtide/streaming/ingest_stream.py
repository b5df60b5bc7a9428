"""The per-line ingest over a folder that keeps receiving dump files.

Accepting and standardising a line needs no state, so the batch functions run unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from moodtide.config import Study
from moodtide.operators.ingest import keep_accepted
from moodtide.sources.text_lines import DUMP_GLOB


def stream_accepted(spark: SparkSession, path: str, study: Study, files_per_batch: int = 1000) -> DataFrame:
    """Accepted posts of every file that appears at ``path``."""
    lines = (
        spark.readStream.option("pathGlobFilter", DUMP_GLOB)
        .option("maxFilesPerTrigger", files_per_batch).text(path)
    )
    return keep_accepted(lines, study)


def append_accepted(accepted: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet until no file is left, then stop; call again to pick up new files."""
    return (
        accepted.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(out)
    )
