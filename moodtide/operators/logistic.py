"""The minimum of the objective of logistic regression, the penalty plus C times the loss summed over the rows.

A pass over the rows gives the objective and its slopes at some coefficients: every task adds up its own rows in
numpy, and only sums as long as the vocabulary leave it. Between the passes the driver takes steps of L-BFGS. How
many passes that needs depends on the scale: terms of few rows curve the objective by little more than the penalty,
common ones by thousands, so the steps start from each coefficient's own curvature.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.session import ship_package

#: Entries of a block of rows, about; a task holds one block at a time, and its arrays stay in a core's cache.
BLOCK_ENTRIES = 1 << 17
#: Steps that L-BFGS remembers, as two vectors of the vocabulary's size each.
MEMORY = 100
#: From this number of tasks on, their sums meet in a stage of their own before the driver.
_FLAT_TASKS = 32
#: Largest slope of the stated objective at which the search may end, whatever the tolerance.
MAX_SLOPE = 0.001
# A step must lower the objective by this part of what its slope says. Below a part _ROUNDING of it, nothing can be told.
_ENOUGH, _ROUNDING = 1e-4, 1e-12


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        lengths = pc.fill_null(pc.list_value_length(batch.column("idx")), 0).to_numpy(zero_copy_only=False).astype(np.int32)
        idx, weight = (batch.column(name).flatten().to_numpy(zero_copy_only=False) for name in ("idx", "weight"))
        before = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        start = 0
        while start < len(labels):
            end = max(start + 1, int(np.searchsorted(before, before[start] + BLOCK_ENTRIES, "right")) - 1)
            rows, entries = slice(start, end), slice(before[start], before[end])
            parts = labels[rows], lengths[rows], idx[entries], weight[entries]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], ["label", "length", "idx", "weight"])
            start = end


def row_blocks(vectors: DataFrame) -> RDD:
    """The rows (label, entries) as blocks of (labels, entries per row, indices, weights), each the bytes of an array."""
    ship_package(vectors.sparkSession)
    columns = vectors.select(
        F.col("label").cast("double").alias("label"), F.col("entries.idx").cast("array<int>").alias("idx"),
        F.col("entries.weight").cast("array<double>").alias("weight"),
    )
    return columns.mapInArrow(_packed, "label binary, length binary, idx binary, weight binary").rdd.map(tuple)


def _arrays(block: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b, t) for b, t in zip(block, (np.float64, np.int32, np.int32, np.float64)))


def _row_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per row the sum of its entries' values; a row without entries has 0."""
    sums, filled = np.zeros(len(lengths)), np.flatnonzero(lengths)
    if len(filled):
        sums[filled] = np.add.reduceat(values, (np.cumsum(lengths) - lengths)[filled])
    return sums


def _total(blocks: RDD, sums) -> np.ndarray:
    """What ``sums`` gives for every block, added up."""
    depth = 1 if blocks.getNumPartitions() <= _FLAT_TASKS else 2
    return blocks.mapPartitions(lambda of_task: [sum(map(sums, of_task))]).treeReduce(add, depth)


def _figures(blocks: RDD, size: int) -> np.ndarray:
    """Per index the sum of squared weights, then the rows, those of label 0 and those of label 1."""

    def sums(block: tuple) -> np.ndarray:
        labels, _, idx, weight = _arrays(block)
        squares = np.bincount(idx, weight * weight, size)
        return np.concatenate([squares, [len(labels), np.count_nonzero(labels == 0), np.count_nonzero(labels == 1)]])

    return _total(blocks, sums)


def _loss(blocks: RDD, at: np.ndarray) -> np.ndarray:
    """The slopes of the summed loss by coefficient and by the intercept, which is the last of ``at``, then the loss."""

    def sums(block: tuple) -> np.ndarray:
        labels, lengths, idx, weight = _arrays(block)
        side = 2.0 * labels - 1.0
        margin = side * (_row_sums(at.take(idx) * weight, lengths) + at[-1])
        error = -side * 0.5 * (1.0 - np.tanh(0.5 * margin))
        slopes = np.bincount(idx, np.repeat(error, lengths) * weight, len(at) - 1)
        return np.concatenate([slopes, [error.sum(), np.logaddexp(0.0, -margin).sum()]])

    return _total(blocks, sums)


def _direction(slope: np.ndarray, curvature: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The step of L-BFGS: minus the slope times the inverse curvature that the remembered steps and changes of
    slope tell, begun from ``curvature``."""
    left, shares = slope.copy(), []
    for step, change in reversed(steps):
        shares.append((step @ left) / (step @ change))
        left -= shares[-1] * change
    if steps:
        step, change = steps[-1]
        left *= (step @ change) / (change @ (change / curvature))
    left /= curvature
    for (step, change), share in zip(steps, reversed(shares)):
        left += (share - (change @ left) / (step @ change)) * step
    return -left


def fit(vectors: DataFrame, size: int, c: float, max_iter: int, tolerance: float) -> tuple[np.ndarray, float]:
    """Coefficients by index and the intercept, which carries no penalty.

    The penalty curves the objective by 1 at least in every coefficient. So at slopes of length s it is within
    s^2 / 2 of its minimum, and the search ends when that is at most ``tolerance`` of it and no slope is above
    ``MAX_SLOPE``. With rows of one class only, all coefficients are 0 and the intercept is infinite.
    """
    blocks = row_blocks(vectors).persist(StorageLevel.MEMORY_AND_DISK_DESER)  # bytes: kept as they go to the passes
    try:
        figures = _figures(blocks, size) if blocks.getNumPartitions() else 0
        if not np.any(figures):
            raise ValueError("logistic regression needs rows")
        squares, (rows, negative, positive) = figures[:size], figures[size:]
        if negative + positive != rows or not np.isfinite(squares).all():
            raise ValueError("logistic regression needs the labels 0 and 1 and finite weights")
        if negative == 0 or positive == 0:
            return np.zeros(size), math.inf if positive else -math.inf
        penalty, share = np.append(np.ones(size), 0.0), positive / rows
        curvature = penalty + c * share * (1.0 - share) * np.append(squares, rows)

        def objective(at: np.ndarray) -> tuple[float, np.ndarray]:
            loss = _loss(blocks, at)
            return 0.5 * float(penalty @ (at * at)) + c * float(loss[-1]), penalty * at + c * loss[:-1]

        at = np.append(np.zeros(size), math.log(positive / negative))
        value, slope = objective(at)
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(max_iter):
            if slope @ slope <= 2.0 * tolerance * value and np.abs(slope).max() <= MAX_SLOPE:
                break
            direction, part = _direction(slope, curvature, steps), 1.0
            falls = direction @ slope
            while True:
                new_value, new_slope = objective(at + part * direction)
                if new_value <= value + _ENOUGH * part * falls + _ROUNDING * value:
                    break
                part *= 0.5
            step, change = part * direction, new_slope - slope
            if step @ change > 0.0:  # always, but for rounding
                steps = [*steps[1 - MEMORY:], (step, change)]
            at, value, slope = at + step, new_value, new_slope
        else:
            warnings.warn(f"logistic regression ended after {max_iter} steps at a slope of {np.abs(slope).max():.2g}")
        return at[:-1], float(at[-1])
    finally:
        blocks.unpersist()
