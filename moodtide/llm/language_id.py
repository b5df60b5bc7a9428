"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training documents. The weights are fitted by
follow-the-regularised-leader with an elastic-net penalty (L1 makes them sparse, L2 shrinks them) on a
bounded, hash-chosen sample with equal room for each language; a temperature fitted on a part of the
sample that the weights have not seen makes the scores probabilities. Prediction is map-only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import map_batches, slices, texts_of

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Documents, at most about, that the weights are fitted on; a fifth of them fits the temperature.
SAMPLE = 4_000
UNDETERMINED = "und"
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@dataclass(frozen=True)
class Ftrl:
    """Step size, its damping, the two penalties, and passes over the sample."""

    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.01
    passes: int = 3


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # languages x buckets, IDF already in them
    bias: np.ndarray
    temperature: float


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@dataclass(frozen=True)
class Grams:
    """Hashed n-grams of some texts: for each order, the buckets at every place of the joined texts, of which
    text i has those from ``starts[i]`` up to ``ends[i]`` - order + 1."""

    buckets: list[np.ndarray]
    starts: np.ndarray
    ends: np.ndarray
    has_letter: np.ndarray

    def of(self, i: int) -> np.ndarray:
        a, b = self.starts[i], self.ends[i]
        return np.concatenate([h[a : max(a, b - order + 1)] for order, h in zip(ORDERS, self.buckets)])

    def sizes(self) -> np.ndarray:
        return sum(np.maximum(self.ends - self.starts - order + 1, 0) for order in ORDERS)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each text, the sum of the values of its grams' buckets."""
        total = np.zeros(len(self.starts))
        for order, h in zip(ORDERS, self.buckets):
            total += _range_sums(values[h], self.starts, np.maximum(self.ends - order + 1, self.starts))
        return total


def _range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(starts))
    pairs = np.stack([starts, ends], axis=1).ravel()
    sums = np.add.reduceat(np.append(values, 0.0), np.minimum(pairs, len(values)))[::2]
    return np.where(ends > starts, sums, 0.0)


def grams_of(texts: list[str]) -> Grams:
    """Letters are lower-cased; a run of other characters is one blank."""
    encoded = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(e) // 4 for e in encoded], dtype=np.int64)))
    codes = np.frombuffer(b"".join(encoded), np.uint32)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[starts[:-1][starts[:-1] < len(codes)]] = True
    places = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))[starts]
    has_letter = _range_sums(letter.astype(np.float64), starts[:-1], starts[1:]) > 0
    codes = np.where(letter, codes, np.uint32(32))[keep]
    h, found = np.zeros(len(codes), np.uint32), []
    for order in ORDERS:  # each order goes on from the one before
        h = (h[: max(0, len(codes) - order + 1)] ^ codes[order - 1 :]) * _MIX[order - 1]
        h ^= h >> np.uint32(15)
        found.append((h * np.uint32(0x27D4EB2F) >> np.uint32(16)).astype(np.intp))
    return Grams(found, places[:-1], places[1:], has_letter)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Documents that have each n-gram bucket, and documents, over the whole table. What comes to the driver
    has one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, seen = np.zeros(BUCKETS, np.int64), 0, np.zeros(BUCKETS, bool)
        for part in slices(batches):
            grams = grams_of(texts_of(part.column(0)))
            for i in range(part.num_rows):
                seen[:] = False
                seen[grams.of(i)] = True
                total += seen
            n += part.num_rows
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(there, -1), pa.int32()), pa.array(np.append(total[there], n), pa.int64())], names=["bucket", "n"]
        )

    counted = map_batches(docs.select(F.col(text).cast("string")), count, "bucket int, n bigint")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    frequencies = np.zeros(BUCKETS + 1, np.int64)
    frequencies[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)  # -1 is the last place
    return frequencies[:BUCKETS], int(frequencies[BUCKETS])


def _sample(docs: DataFrame, text: str, label: str, key: str, limit: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, buckets, counts) of a sample of distinct rows, chosen by a hash of id and text, with equal room
    for each language: about ``limit`` rows, as the shares come from counts of distinct rows."""
    row = F.xxhash64(F.lit("language"), key, F.col(text).cast("string"))
    hashed = docs.select(F.col(label).alias("lang"), row.alias("h"))
    sizes = {r["lang"]: r["n"] for r in hashed.distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return []
    room = max(1, limit // len(sizes))
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, room / n))])
    chance = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    rows = docs.select(F.col(label).alias("lang"), F.col(text).cast("string").alias("text"), row.alias("h"))
    chosen = rows.filter(chance < share[F.col("lang")]).dropDuplicates(["lang", "h"]).select("lang", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            grams = grams_of(texts_of(part.column(1)))
            pairs = [np.unique(grams.of(i), return_counts=True) for i in range(part.num_rows)]
            lists = [pa.array([p[i].tolist() for p in pairs], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), *lists], names=["lang", "buckets", "counts"])

    found = map_batches(chosen, features, "lang string, buckets array<int>, counts array<int>").toPandas()
    rows = zip(found["lang"], found["buckets"], found["counts"])
    arrays = ((a, np.asarray(b, np.int64), np.asarray(c, np.float64)) for a, b, c in rows)
    return sorted(arrays, key=lambda r: (r[0], len(r[1]), r[2].sum(), r[1].sum()))  # an order of their own


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, settings: Ftrl, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of (buckets, values, class) rows."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))  # the last row is the bias

    def weights(at) -> np.ndarray:
        shrink = np.where(np.asarray(at)[..., None] == BUCKETS, 0.0, settings.l1)
        step = (settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2
        return np.where(np.abs(z[at]) <= shrink, 0.0, -(z[at] - np.sign(z[at]) * shrink) / step)

    order = np.random.default_rng(seed)
    for _ in range(settings.passes):
        for i in order.permutation(len(rows)):
            buckets, values, label = rows[i]
            at, x = np.append(buckets, BUCKETS), np.append(values, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[label] -= 1.0
            gradient = x[:, None] * p
            squared = gradient**2
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / settings.alpha * w
            n[at] += squared
    w = weights(np.arange(BUCKETS + 1))
    return w[:BUCKETS], w[BUCKETS]


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss; 1 without rows."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(-2.5, 2.5, 101))
    losses = [-np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def train(
    docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", sample: int = SAMPLE, settings: Ftrl = Ftrl()
) -> LanguageModel:
    """Fit a model on documents with a language; rows with a null label are left out. Without any labelled
    row the model knows no language. ``sample`` bounds the documents the weights are fitted on."""
    labelled = docs.filter(F.col(label).isNotNull())
    chosen = _sample(labelled, text, label, key, sample)
    languages = tuple(sorted({r[0] for r in chosen}))
    if not languages:
        return LanguageModel((), np.zeros((0, BUCKETS)), np.zeros(0), 1.0)
    frequencies, total = document_frequencies(labelled, text)
    idf = np.log((1.0 + total) / (1.0 + frequencies)) + 1.0
    place = {lang: i for i, lang in enumerate(languages)}
    rows = [(b, 100.0 * c / c.sum() * idf[b], place[lang]) for lang, b, c in chosen if len(b)]
    held = [r for i, r in enumerate(rows) if i % 5 == 4]
    weights, bias = fit_ftrl([r for i, r in enumerate(rows) if i % 5 != 4], len(languages), settings)
    logits = np.array([x @ weights[b] + bias for b, x, _ in held]).reshape(-1, len(languages))
    temperature = fit_temperature(logits, np.array([y for *_, y in held], np.int64))
    return LanguageModel(languages, np.ascontiguousarray((100.0 * idf[:, None] * weights).T), bias, temperature)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", key: str | Column = "doc_id") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (calibrated probability of the prediction).

    Null and empty texts, texts without a letter, and every text if the model knows no language are
    ``und`` with score 0. Whole texts are read, whatever their length. Equal probabilities: the first
    language in code-point order. Null ids and repeated rows give a row each; an empty table gives none.
    Only the text is used; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in slices(batches):
            grams = grams_of(texts_of(part.column(1)))
            known = grams.has_letter & bool(m.languages)
            best, score = np.zeros(len(known), np.int64), np.zeros(len(known))
            if m.languages:
                sums = np.stack([grams.sums(w) for w in m.weights], axis=1)
                p = _softmax((sums / np.maximum(grams.sizes(), 1)[:, None] + m.bias) / m.temperature)
                best, score = p.argmax(axis=1), p.max(axis=1)
            names = [m.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))],
                names=["doc_id", "lang_pred", "score"],
            )

    doc_id = (F.col(key) if isinstance(key, str) else key).cast("bigint").alias("doc_id")
    rows = docs.select(doc_id, F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id bigint, lang_pred string, score double")
