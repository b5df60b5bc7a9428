"""Toxicity by weak supervision.

Voters are lexicon entries (word beginnings and whole words that are far more frequent in toxic documents),
each at several levels of frequency, and surface patterns. A generative label model estimates, by
expectation maximisation, how often each voter fires on toxic and on clean documents, and from the voters'
remaining correlations how much its vote is worth beside the others'. A linear classifier is trained on
the posterior labels. Training sees a bounded sample of labelled documents; scoring is map-only and finds
all entries in one pass over a text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import map_batches, slices, texts_of
from moodtide.session import durable

#: Labelled documents, about, that the model is fitted on; half of them toxic if there are enough.
SAMPLE = 8_000
#: Lexicon entries of a model, at most.
ENTRIES = 150
#: A lexicon entry occurs in this many toxic documents, and this many times as often there, by words, as in clean ones.
LEAST_DOCUMENTS, LEAST_RATIO = 5, 10.0
#: An entry has a voter for each level: it fires if the entry has a larger share of a text's words.
LEVELS = (0.0, 0.003, 0.008)
_PREFIXES = (4, 5, 6, 7)

_word = re.compile(r"\w+")


@dataclass(frozen=True)
class Pattern:
    """A voter that looks at the surface of a text."""

    name: str
    expression: str
    least: int

    def fires(self, text: str) -> bool:
        return len(re.findall(self.expression, text)) >= self.least


PATTERNS = (
    Pattern("exclamations", r"!{2,}", 1),
    Pattern("shouted_words", r"\b[A-Z]{4,}\b", 5),
    Pattern("masked_word", r"\b\w[*#@]{2,}\w*", 1),
    Pattern("second_person_insult", r"(?i)\byou(?:'re| are)? (?:an? )?\w+[!.]", 2),
)


@dataclass(frozen=True)
class LabelModel:
    """Share of toxic documents; for each voter, how often it fires on clean and toxic ones, and its worth."""

    prior: float
    fires: np.ndarray  # voters x 2
    worth: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that a document is toxic, from its votes (documents x voters, 0 or 1). A voter that does
        not fire abstains: a document needs few of the many entries to be toxic; silence is a voter of its own."""
        evidence = self.worth * np.log(self.fires[:, 1] / self.fires[:, 0])
        return _sigmoid(np.log(self.prior / (1 - self.prior)) + votes @ evidence)


@dataclass(frozen=True)
class ToxicityModel:
    entries: tuple[str, ...]  # "^abc" is a beginning of words, "abc" a whole word
    weights: np.ndarray  # of the entries' levels, then of the patterns
    bias: float
    labels: LabelModel


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def entries_of(text: str) -> tuple[int, Counter]:
    """The number of words of a text, and how many of them support each possible lexicon entry."""
    words = Counter(_word.findall(text.lower()))
    found: Counter = Counter()
    for word, n in words.items():
        if len(word) >= 3:
            found[word] += n
        for size in _PREFIXES:
            if len(word) >= size:
                found["^" + word[:size]] += n
    return words.total(), found


class Voters:
    """Finds the voters that fire on a text: the entries' levels, then the patterns."""

    def __init__(self, entries: tuple[str, ...]):
        self.first_pattern = len(entries) * len(LEVELS)
        self.size = self.first_pattern + len(PATTERNS)
        by_text: dict[str, list[tuple[int, bool]]] = {}
        for i, entry in enumerate(entries):
            by_text.setdefault(entry.lstrip("^"), []).append((i, not entry.startswith("^")))
        self._find = ahocorasick.Automaton()
        for key, kinds in by_text.items():
            self._find.add_word(key, (len(key), kinds))
        self._any = bool(by_text)
        if self._any:
            self._find.make_automaton()

    def fire(self, text: str) -> list[int]:
        lowered, counts = text.lower(), Counter()
        if self._any:
            for end, (size, kinds) in self._find.iter(lowered):
                start = end - size
                if start >= 0 and (lowered[start].isalnum() or lowered[start] == "_"):
                    continue
                after = lowered[end + 1 : end + 2]
                inside = after.isalnum() or after == "_"
                counts.update(i for i, whole in kinds if not (whole and inside))
        words = len(_word.findall(lowered)) if counts else 0
        found = [i * len(LEVELS) + k for i, n in counts.items() for k, level in enumerate(LEVELS) if n > level * words]
        return sorted(found + [self.first_pattern + i for i, p in enumerate(PATTERNS) if p.fires(text)])


def with_silence(votes: np.ndarray) -> np.ndarray:
    """The votes and one more voter, for clean: no other voter fires."""
    return np.hstack([votes, ~votes.any(axis=1, keepdims=True)])


def fit_label_model(votes: np.ndarray, start: np.ndarray, share: np.ndarray, rounds: int = 10) -> LabelModel:
    """Label model of documents x voters votes.

    ``start`` has the labels that the lexicon was drawn from. They are the first guesses of the posteriors,
    give the share of toxic documents, and stay half of the evidence about each voter, so that the rounds
    cannot drift to a split of their own. ``share`` is a weight for each document. Voters that still fire
    together given the label repeat each other: a voter's worth is one over the sum of its squared positive
    correlations, itself included.
    """
    weight, posterior = share / share.sum(), start.astype(float)
    n, voters = votes.shape
    worth, fires = np.ones(voters), np.full((voters, 2), 0.5)
    prior = float(np.clip((weight * posterior).sum(), 1e-4, 1 - 1e-4))
    for _ in range(rounds):
        toxic = weight * (posterior + start) / 2
        clean = weight - toxic
        small = 1.0 / max(n, 1)
        fires = np.stack([(side @ votes + small * 0.5) / (side.sum() + small) for side in (clean, toxic)], axis=1)
        fires = np.clip(fires, 1e-6, 1 - 1e-6)
        rest = votes - (clean[:, None] * fires[:, 0] + toxic[:, None] * fires[:, 1]) / np.maximum(weight, 1e-12)[:, None]
        covariance = (rest * weight[:, None]).T @ rest
        spread = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
        alike = np.maximum(covariance / np.outer(spread, spread), 0.0)
        worth = 1.0 / np.maximum((alike**2).sum(axis=1), 1.0)
        posterior = LabelModel(prior, fires, worth).posterior(votes)
    return LabelModel(prior, fires, worth)


def fit_linear(x: np.ndarray, soft: np.ndarray, share: np.ndarray, l2: float = 1.0, steps: int = 25) -> tuple[np.ndarray, float]:
    """Weights and bias of ridge logistic regression on soft labels, by Newton's method."""
    full = np.hstack([x, np.ones((len(x), 1))])
    weight = share * len(share) / share.sum()
    penalty = np.full(full.shape[1], l2)
    penalty[-1] = 1e-3
    w = np.zeros(full.shape[1])
    for _ in range(steps):
        p = _sigmoid(full @ w)
        gradient = full.T @ (weight * (p - soft)) + penalty * w
        curve = (full * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ full + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _chosen_labels(labels: DataFrame, key: str, label: str, limit: int) -> tuple[DataFrame, dict[int, int]]:
    """A bounded, hash-chosen (doc_id, toxic) sample, and all labelled documents by label. Documents with
    several labels are toxic if any is."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(key).alias("doc_id")).agg(F.max((F.col(label) != 0).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chance = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, limit / 2 / max(1, sizes.get(1, 0)))).otherwise(
        min(1.0, limit / 2 / max(1, sizes.get(0, 0)))
    )
    return durable(known.filter(chance < share)), sizes


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", sample: int = SAMPLE
) -> ToxicityModel:
    """Fit a model on documents (doc_id, text) and labels (doc_id, toxic). ``sample`` bounds the documents it
    is fitted on; of an id that stands on several rows it has one, chosen by a hash of the text. Null ids and
    labels are left out. Without toxic or without clean documents, the model has no entries and scores by the
    share of toxic labels alone."""
    chosen, sizes = _chosen_labels(labels, doc_id, label, sample)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")  # of the texts of an id
    texts = durable(
        rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(one, F.first("toxic").alias("toxic"))
    )  # as bounded as the sample

    def supported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            for (words, found), toxic in zip(map(entries_of, texts_of(part.column(1))), part.column(2).to_pylist()):
                yield pa.RecordBatch.from_pydict(
                    {"toxic": [toxic] * (len(found) + 1), "entry": [None, *found], "n": [words, *found.values()]}, supports
                )

    supports = pa.schema([("toxic", pa.int32()), ("entry", pa.string()), ("n", pa.int64())])
    spread = texts.repartition(2 * texts.sparkSession.sparkContext.defaultParallelism)
    toxic, n = F.col("toxic") == 1, F.col("n")
    by_entry = durable(
        map_batches(spread, supported, "toxic int, entry string, n bigint").groupBy("entry").agg(
            F.sum(F.when(toxic, n).otherwise(0)).alias("in_toxic"), F.sum(F.when(toxic, 0).otherwise(n)).alias("in_clean"),
            F.sum(F.col("toxic")).alias("toxic_docs"), F.sum(1 - F.col("toxic")).alias("clean_docs"),
        )
    )
    whole = by_entry.filter(F.col("entry").isNull()).first()  # words and documents of either label
    n_toxic, n_clean = (whole["toxic_docs"], whole["clean_docs"]) if whole else (0, 0)
    empty = LabelModel(sizes.get(1, 0) / max(1, sum(sizes.values())), np.zeros((0, 2)), np.zeros(0))
    if not (n_toxic and n_clean and whole["in_toxic"] and whole["in_clean"]):
        prior = min(max(empty.prior, 1e-3), 1 - 1e-3)
        return ToxicityModel((), np.zeros(len(PATTERNS)), float(np.log(prior / (1 - prior))), empty)
    ratio = ((F.col("in_toxic") + 0.5) / whole["in_toxic"]) / ((F.col("in_clean") + 0.5) / whole["in_clean"])
    good = by_entry.filter(
        F.col("entry").isNotNull() & (F.col("toxic_docs") >= LEAST_DOCUMENTS) & (ratio >= LEAST_RATIO)
    )
    same = good.groupBy("in_toxic", "in_clean", "toxic_docs", "clean_docs").agg(  # one of several beginnings of the same words
        F.max_by("entry", F.struct(F.length("entry"), "entry")).alias("entry")
    )
    best = same.orderBy((F.col("toxic_docs") * F.log(ratio)).desc(), "entry").limit(ENTRIES)
    entries = tuple(sorted(r["entry"] for r in best.select("entry").collect()))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(entries)
        for part in slices(batches):
            found = [voters.fire(t) for t in texts_of(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "toxic", "fired"]
            )

    ballots = map_batches(spread, vote, "doc_id bigint, toxic int, fired array<int>").toPandas()
    ballots = ballots.sort_values(["doc_id", "toxic"], kind="stable")
    votes = np.zeros((len(ballots), Voters(entries).size), bool)
    for i, fired in enumerate(ballots["fired"]):
        votes[i, np.asarray(fired, int)] = True
    gold = ballots["toxic"].to_numpy()
    share = np.where(gold == 1, sizes[1] / n_toxic, sizes[0] / n_clean)
    in_toxic, in_clean = votes[gold == 1].sum(axis=0), votes[gold == 0].sum(axis=0)
    votes &= (in_toxic >= LEAST_DOCUMENTS) & (in_toxic / n_toxic >= LEAST_RATIO * (in_clean + 0.5) / n_clean)  # no other voters
    model = fit_label_model(with_silence(votes), gold, share)
    weights, bias = fit_linear(votes.astype(float), model.posterior(with_silence(votes)), share)
    return ToxicityModel(entries, weights, bias, model)


def score(
    docs: DataFrame, model: ToxicityModel, text: str | Column = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns, score (0 to 1) and predicted (1 if the score is 0.5 or more).

    Null and empty texts, on which nothing fires, have the score of the classifier's bias. Whole texts are
    read, whatever their length. Null keys and repeated rows give a row each; an empty table gives none.
    Only the text is used for the score. Kept columns named like a result are replaced.
    """
    keep = tuple(k for k in keep if k not in ("score", "predicted"))
    shared = docs.sparkSession.sparkContext.broadcast((model.entries, model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, weights, bias = shared.value
        voters = Voters(entries)
        for part in slices(batches):
            sums = np.array([weights[voters.fire(t)].sum() for t in texts_of(part.column(0))])
            scores = _sigmoid(sums + bias)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*keep, "score", "predicted"],
            )

    rows = docs.select((F.col(text) if isinstance(text, str) else text).cast("string").alias("_text"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return map_batches(rows, run, (schema + ", " if schema else "") + "score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    return score(rows, model, keep=("row",)).filter(F.col("predicted") == 0).select("row.*")
