"""Ranking of a linked list that is spread over a cluster.

Every element gets the sums of the weights from it to the end of its list. About one element in ``SPACING`` is a
ruler, known by a hash of its id, so that nothing has to be looked up to tell one. All elements jump along the
list, doubling their stride, until they stand at a ruler or at the end, which takes a number of rounds that
grows with the logarithm of the longest way to a ruler. The rulers alone are a list a ``SPACING``-th as long,
ranked in the same way; then every element adds the sums of the ruler at which it stands. A list of at most
``BASE`` elements is ranked in one task. Work and shuffled rows are in proportion to the list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from moodtide.llm.common import map_batches
from moodtide.session import durable

SPACING = 16
#: Elements of a list that one task ranks.
BASE = 1 << 14


def _is_ruler(element: Column | str, level: int, spacing: int) -> Column:
    return F.pmod(F.xxhash64(element, F.lit(level)), F.lit(spacing)) == 0


def _counted(df: DataFrame, condition: Column) -> tuple[DataFrame, int]:
    """``df``, written, and how many of its rows meet the condition."""
    seen = Observation()
    written = durable(df.observe(seen, F.count_if(condition).alias("n")))
    return written, seen.get["n"]


def _ranked_in_one_task(links: DataFrame, weights: tuple[str, ...]) -> DataFrame:
    schema = links.select("id", *weights).schema

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        ids, following = whole["id"].to_numpy(), whole["next"]
        n, order = len(ids), np.argsort(ids)
        has_next = ~following.is_null().to_numpy(zero_copy_only=False)
        after = np.full(n + 1, n)
        after[:n][has_next] = order[np.searchsorted(ids[order], following.drop_null().to_numpy())]
        sums = [np.append(whole[w].to_numpy(), 0) for w in weights]
        while (after[:n] != n).any():  # doubles its stride each time
            sums = [s + s[after] for s in sums]
            after = after[after]
        yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(s[:n]) for s in sums)], names=["id", *weights])

    simple = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return durable(map_batches(links.select("id", "next", *weights).coalesce(1), rank, simple))


def suffix_sums(
    links: DataFrame, count: int, weights: tuple[str, ...], spacing: int = SPACING, base: int = BASE, level: int = 0
) -> DataFrame:
    """(id, weights): for each element the sums of the weights from it, itself included, to the end of its list.

    ``links`` is a written table (id long, next long or null, weights long) of ``count`` rows, one or more lists;
    ids are unique, and every ``next`` is an id or null, at the end of a list. An empty table gives no rows.
    """
    if count <= base:
        return _ranked_in_one_task(links, weights)

    def on_its_way(at: str) -> Column:
        return F.col(at).isNotNull() & ~_is_ruler(at, level, spacing)

    walked, moving = _counted(links.select("id", F.col("next").alias("at"), *weights), on_its_way("at"))
    while moving:
        target = walked.select(F.col("id").alias("_id"), F.col("at").alias("_at"), *[F.col(w).alias(f"_{w}") for w in weights])
        target = target.filter(~_is_ruler("_id", level, spacing))
        jumped = walked.filter(on_its_way("at")).join(target, F.col("at") == F.col("_id")).select(
            "id", F.col("_at").alias("at"), *[(F.col(w) + F.col(f"_{w}")).alias(w) for w in weights]
        )
        walked, moving = _counted(walked.filter(~on_its_way("at")).unionByName(jumped), on_its_way("at"))
    rulers, n = _counted(walked.filter(_is_ruler("id", level, spacing)).select("id", F.col("at").alias("next"), *weights), F.lit(True))
    ranked = suffix_sums(rulers, n, weights, spacing, base, level + 1)
    beyond = ranked.select(F.col("id").alias("_id"), *[F.col(w).alias(f"_{w}") for w in weights])
    joined = walked.join(beyond, F.col("at") == F.col("_id"), "left")
    return durable(joined.select("id", *[(F.col(w) + F.coalesce(f"_{w}", F.lit(0))).alias(w) for w in weights]))
