"""Blocked Bloom filter: each key sets eight bits in one 256-bit block.

It is built by one aggregate (bitwise or per block) and probed map-side. Its size is bounded by
``max_bytes`` whatever the number of keys, so it may be broadcast; a filter that is too small for its
keys only passes more rows to the exact step that must follow.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.session import ship_package

BITS_PER_KEY = 16
MAX_BYTES = 4 << 20

#: Odd multipliers, one per 32-bit word of a block.
_SALTS = tuple(0x9E3779B1 + 0x3C6EF372 * i & 0xFFFFFFFF | 1 for i in range(8))
_LOW = 0x7FFFFFFF


def build(keys: DataFrame, count: int, max_bytes: int = MAX_BYTES) -> np.ndarray:
    """Filter of the 64-bit hashes in column ``h``; an array of blocks x 8 words.

    ``count`` (keys) only sets the size. An empty input gives a filter that passes nothing.
    """
    wanted = max(1, count * BITS_PER_KEY // 256)
    log2 = min(wanted.bit_length(), (max_bytes // 32).bit_length() - 1)
    low = F.col("h").bitwiseAND(_LOW)
    words = [
        F.expr(f"bit_or(shiftleft(1, cast(b{i} as int)))").alias(f"w{i}") for i in range(8)
    ]
    bits = [F.shiftright(low * s, 26).bitwiseAND(31).alias(f"b{i}") for i, s in enumerate(_SALTS)]
    block = F.shiftrightunsigned("h", 64 - log2).alias("block")
    rows = keys.filter(F.col("h").isNotNull()).select(block, *bits).groupBy("block").agg(*words).toPandas()
    filled = np.zeros((1 << log2, 8), np.uint32)
    if len(rows):
        filled[rows["block"].to_numpy()] = rows[[f"w{i}" for i in range(8)]].to_numpy().astype(np.int32).view(np.uint32)
    return filled


def contains(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each 64-bit hash may be in the filter; never false for a key."""
    h = hashes.astype(np.int64).view(np.uint64)
    block = filled[(h >> np.uint64(65 - len(filled).bit_length())).astype(np.int64)]
    low = h & np.uint64(_LOW)
    found = np.ones(len(h), bool)
    for i, salt in enumerate(_SALTS):
        bit = (low * np.uint64(salt) >> np.uint64(26)).astype(np.uint32) & np.uint32(31)
        found &= (block[:, i] >> bit & np.uint32(1)).astype(bool)
    return found


def may_contain(df: DataFrame, filled: np.ndarray, h: Column | str) -> Column:
    """Boolean column: the filter passes the hash ``h``. Null hashes do not pass."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(filled)

    @F.pandas_udf("boolean")
    def probe(h: pd.Series) -> pd.Series:
        return pd.Series(contains(shared.value, h.fillna(0).to_numpy(np.int64)) & h.notna().to_numpy())

    return probe(h)
