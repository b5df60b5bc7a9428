"""Quality rules as a bitmask ledger.

Every measurement of a text is taken once, and every rule is evaluated once into one bit of a mask.
The ledger (key, measurements, mask) is small and is kept; a policy is a named, versioned set of
rules, applied to the ledger by bitwise operations without touching a text again, and the effect of
dropping or adding a rule is a bitwise aggregate over the ledger.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import map_batches, slices, texts_of, with_columns

#: Words of a window that counts as repeated when it occurs twice in a text.
WINDOW = 5
SYMBOLS = "#*$%&|<>"
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_words = re.compile(r"[^\x20\x09-\x0D]+").findall

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition on the measurements; ``bit`` is the rule's place in the mask for good."""

    bit: int
    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """A document is rejected if it fails any of the named rules."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...]) -> int:
        known = {r.name: r.bit for r in rules}
        return sum(1 << known[n] for n in self.rules)


RULES = (
    Rule(0, "too_few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "short_words", "word_chars < 2 * n_words"),
    Rule(3, "long_words", "word_chars > 20 * n_words"),
    Rule(4, "many_symbols", "10 * n_symbols > n_words"),
    Rule(5, "repeated_lines", "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines"),
)
#: The rules that every policy must contain.
BASE = Policy("base", ("too_few_words", "repeated_windows"))
V1 = Policy("v1", tuple(r.name for r in RULES))


def repeated_words(ids: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in that text.

    ``ids`` numbers the words of all texts one after the other, ``starts`` has each text's first place
    and the end. Windows are compared exactly: equal windows get equal ranks, built up from ranks of
    shorter ones by sorting.
    """
    n, lengths = len(ids), np.diff(starts)
    if n < window:
        return np.zeros(len(lengths), np.int64)
    text = np.repeat(np.arange(len(lengths)), lengths)
    rank = ids.astype(np.int64)
    for width in range(2, window + 1):  # rank of the window of `width` words at each place
        wide = rank[: n - width + 1] * (int(ids.max()) + 1) + ids[width - 1 :]
        rank = np.unique(wide, return_inverse=True)[1].astype(np.int64)
    inside = text[: n - window + 1] == text[window - 1 :]
    key = (text[: n - window + 1] * (int(rank.max()) + 1) + rank)[inside]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    at = np.flatnonzero(inside)[counts[inverse] > 1]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    covered = np.cumsum(change[:n]) > 0
    return np.bincount(text[covered], minlength=len(lengths))


def measure_texts(texts: list[str]) -> dict[str, np.ndarray]:
    """The measurements of each text."""
    words = [_words(t) for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    lines = [[x for x in t.split("\n") if x.strip(_SPACE)] for t in texts]
    flat = [w for ws in words for w in ws]
    ids = pd.factorize(np.array(flat, object))[0] if flat else np.zeros(0, np.int64)
    return {
        "n_words": counts,
        "word_chars": np.array([sum(map(len, ws)) for ws in words], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_lines": np.array([len(x) for x in lines], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": repeated_words(ids, np.concatenate(([0], np.cumsum(counts)))),
    }


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, measurements) of every whole text, in one pass and without a shuffle."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield with_columns(part, ["doc_id"], **measure_texts(texts_of(part.column(1))))

    schema = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, measure, schema)


def mask_of(rules: tuple[Rule, ...] = RULES) -> Column:
    """The failure bits as one long."""
    mask = F.lit(0).cast("long")
    for rule in rules:
        mask = mask + F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long")
    return mask


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, the measurements, failed (bitmask).

    Null and empty texts have no words: they fail ``too_few_words`` and no rule that compares shares.
    Repeated rows and null ids give a row each; an empty table gives none. Other columns are ignored.
    """
    return measured(docs, text, doc_id).withColumn("failed", mask_of(rules))


def apply_policy(entries: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add kept and policy to ledger rows; no text is read."""
    return entries.withColumn("kept", F.col("failed").bitwiseAND(policy.mask(rules)) == 0).withColumn(
        "policy", F.lit(policy.version)
    )


def ablations(entries: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of a policy: rejected (documents that fail it), only (those that fail no other rule
    of the policy, so would stay without it), and total (documents rejected by the policy).

    One aggregate over the distinct masks, of which there are at most two to the number of rules.
    """
    whole = policy.mask(rules)
    masks = entries.groupBy(F.col("failed").bitwiseAND(whole).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    parts = []
    for rule in rules:
        if rule.name in policy.rules:
            bit = 1 << rule.bit
            parts.append(
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.sum(F.when(F.col("m").bitwiseAND(bit) != 0, n).otherwise(0)).alias("rejected"),
                    F.sum(F.when(F.col("m") == bit, n).otherwise(0)).alias("only"),
                    F.sum(F.when(F.col("m") != 0, n).otherwise(0)).alias("total"),
                )
            )
    return masks.agg(F.array(*parts).alias("x")).select(F.inline("x"))
