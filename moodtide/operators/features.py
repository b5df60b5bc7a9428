"""Tokens, vocabulary and TF-IDF weights as long tables.

Term counts are taken inside each row (sort the words, read off the run lengths), so the only
rows that ever exist are distinct (document, term) pairs and no shuffle is spent on counting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.session import numbered

# Vocabulary cap and shortest token.
MAX_FEATURES = 50_000
MIN_TOKEN_LENGTH = 2
# Number of a row within one plan: what tells rows apart that share a key.
ROW = "_row"


def tokenize(text: Column) -> Column:
    """Words of cleaned text with at least two letters."""
    return F.filter(F.split(F.lower(text), " "), lambda w: F.length(w) >= MIN_TOKEN_LENGTH)


def term_counts(docs: DataFrame, text: str = "cleaned_text", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """(kept columns, row number, term, tf). Keep only narrow columns: they are repeated per term."""
    return _exploded(docs, text, keep, F.explode).filter(F.length("term") >= MIN_TOKEN_LENGTH)


def _exploded(docs: DataFrame, text: str, keep: tuple[str, ...], generator) -> DataFrame:
    keep = (*keep, ROW)
    words = docs.withColumn(ROW, F.monotonically_increasing_id()).select(*keep, F.sort_array(F.split(F.lower(F.coalesce(text, F.lit(""))), " ")).alias("_w"))
    size = F.size("_w")
    positions = F.sequence(F.lit(0), size - 1)
    is_start = lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1))
    starts = words.select(*keep, "_w", F.filter(positions, is_start).alias("_s"))
    runs = F.transform(
        "_s",
        lambda p, k: F.struct(
            F.get("_w", p).alias("term"), (F.coalesce(F.get("_s", k + 1), F.size("_w")) - p).alias("tf")
        ),
    )
    return starts.select(*keep, generator(runs).alias("_t")).select(*keep, "_t.term", "_t.tf")


def _sublinear(tf: Column) -> Column:
    return F.lit(1.0) + F.log(tf.cast("double"))


def _idf(documents: Column, doc_freq: Column) -> Column:
    return F.log((documents.cast("double") + 1.0) / (doc_freq + 1.0)) + 1.0


def document_frequency(terms: DataFrame, documents: DataFrame) -> DataFrame:
    """Per term: documents holding it, total occurrences and smoothed idf.

    ``documents`` is the frame whose rows are counted; its count is a scalar subquery.
    """
    total = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = terms.groupBy("term").agg(
        F.count(F.lit(1)).alias("doc_freq"), F.sum("tf").alias("corpus_freq")
    )
    return counts.withColumn("idf", _idf(total, F.col("doc_freq")))


def vocabulary_topn(frequencies: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent terms, ties alphabetical.

    A limit keeps its full number of rows from every task until the last one merges them. So the
    terms are counted per power of two of their frequency first, and only those at or above the
    level where the limit falls are ordered. Reads ``frequencies`` twice: pass a written table.
    """
    level = F.floor(F.log2("corpus_freq")).cast("int")
    levels = frequencies.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"))
    at_least = F.sum("n").over(Window.partitionBy().orderBy(F.desc("level")))
    lowest = levels.withColumn("at_least", at_least).filter(F.col("at_least") >= max_features)
    needed = lowest.agg(F.coalesce(F.max("level"), F.lit(-1))).scalar()
    return frequencies.filter(level >= needed).orderBy(F.desc("corpus_freq"), "term").limit(max_features)


def attach_vocabulary(terms: DataFrame, vocabulary: DataFrame, how: str = "inner") -> DataFrame:
    """Terms joined to the vocabulary columns. Pass a written vocabulary or model: its size is then
    known to the planner, which broadcasts a small one and shuffles a large one."""
    return terms.join(vocabulary, "term", how)


def tfidf_weights(terms: DataFrame, vocabulary: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """(kept columns, term, weight): sublinear tf times idf, each document of unit length.

    One shuffle by row number; a document has at most one row per vocabulary term. Rows with the
    same key are different documents.
    """
    weighted = attach_vocabulary(terms, vocabulary.select("term", "idf")).select(
        *keep, ROW, "term", (_sublinear(F.col("tf")) * F.col("idf")).alias("w")
    )
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(ROW)))
    return weighted.select(*keep, "term", (F.col("w") / length).alias("weight"))


def index_vocabulary(vocabulary: DataFrame) -> DataFrame:
    """Adds ``idx``, numbering the terms from 0 without gaps."""
    return numbered(vocabulary.select("term", "idf"), "idx").withColumn("idx", F.col("idx").cast("int"))


def document_vectors(
    docs: DataFrame, indexed: DataFrame, text: str = "cleaned_text", keep: tuple[str, ...] = ("id", "label")
) -> DataFrame:
    """(kept columns, entries): each document's unit-length weights as (idx, weight) by index.

    Gathering the entries and their length is one aggregate, hence one shuffle. Documents without
    a known term stay, with no entries. Rows with the same key are different documents.
    """
    terms = _exploded(docs, text, keep, F.explode_outer)
    known = attach_vocabulary(terms, indexed, "left")
    weight = _sublinear(F.col("tf")) * F.col("idf")
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", F.col("w").alias("weight")))
    gathered = known.select(*keep, ROW, "idx", weight.alias("w")).groupBy(*keep, ROW).agg(
        F.sort_array(F.collect_list(entry)).alias("raw"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length")
    )
    unit = F.transform("raw", lambda e: F.struct(e["idx"].alias("idx"), (e["weight"] / F.col("length")).alias("weight")))
    return gathered.select(*keep, unit.alias("entries"))


def score_documents(
    docs: DataFrame, model: DataFrame, text: str = "cleaned_text", keep: tuple[str, ...] = ("id",)
) -> DataFrame:
    """(kept columns, margin): the linear model's sum over the unit-length weights, without intercept.

    Terms meet a model that is small enough to be broadcast where they are, and each document is
    reduced to two sums before the only shuffle. Documents without a known term stay, with margin 0.
    Rows with the same key are different documents and are scored one by one.
    """
    terms = _exploded(docs, text, keep, F.explode_outer)
    known = attach_vocabulary(terms, model.select("term", "idf", "coefficient"), "left")
    weight = _sublinear(F.col("tf")) * F.col("idf")
    sums = known.select(*keep, ROW, weight.alias("w"), "coefficient").groupBy(*keep, ROW).agg(
        F.sum(F.col("w") * F.col("w")).alias("sq"), F.sum(F.col("w") * F.col("coefficient")).alias("dot")
    )
    margin = F.coalesce(F.try_divide(F.col("dot"), F.sqrt("sq")), F.lit(0.0))
    return sums.select(*keep, margin.alias("margin"))
