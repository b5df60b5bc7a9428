"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.session import prepare_session, ship_package

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of an Arrow batch, about.
BATCH_BYTES = 8 << 20
#: Rows of a text column that are turned into Python strings at a time.
_SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(text, F.lit("")), upper, lower)


def n_words(text: Column | str) -> Column:
    """Number of words of a text; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def id_remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


_tables: list = []


def worker_table(cached):
    """Marks an ``lru_cache`` of large tables: a worker keeps them from task to task of the module that makes them, and
    drops them when it takes up another module's task."""
    _tables.append(cached)
    return cached


def drop_other_tables(module: str) -> None:
    held = [c for c in _tables if c.__module__ != module and c.cache_info().currsize]
    for cached in held:
        cached.cache_clear()
    if held:
        release_memory()


def release_memory() -> None:
    """Hand free memory of this process back to the system. Arrow's pool and the C library keep what was freed, up to
    hundreds of MB in a worker that waits for its next task, and every executor has several of them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks. Batches are bounded by bytes, as texts may be long,
    and a task gives memory back when it ends, as its worker stays for other stages."""
    ship_package(df.sparkSession)
    module = function.__module__
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_other_tables(module)
        yield from function(batches)
        release_memory()

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = _SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces that are cheap to hold as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(column: pa.Array) -> list[str]:
    """A text column as Python strings; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def with_columns(batch: pa.RecordBatch, names: list[str], **added) -> pa.RecordBatch:
    """The named columns of a batch and the added ones (name=array)."""
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays(arrays + [_array(v) for v in added.values()], names=names + list(added))


def _array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
