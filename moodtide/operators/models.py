"""Training, scoring and evaluation of the two sentiment classifiers.

Both end as the same table: one row per term with its idf and coefficient, and one row without a
term holding the intercept. Scoring and storage therefore know one model shape only.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from moodtide.operators import logistic
from moodtide.operators.features import (
    MAX_FEATURES, document_frequency, index_vocabulary, score_documents, term_counts, vocabulary_topn,
)
from moodtide.operators.tagging import label_to_sentiment
from moodtide.session import durable

# Training settings.
TEST_SHARE_PERCENT = 20
SEED = 42
NB_ALPHA = 1.0
LR_C = 1.0
LR_MAX_ITER = 1000
# The solver stops when the objective can fall by this share at most.
LR_TOLERANCE = 1e-10

MODEL_COLUMNS = ("term", "idf", "coefficient")

# Leading hex digits of the row hash that form the histogram of the split (16^4 cells).
_CELL_DIGITS = 4


def split_hash(key: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def split_sizes(label_counts: DataFrame, test_percent: int = TEST_SHARE_PERCENT) -> DataFrame:
    """Rows per label to hold out: the test set has ceil(share * n) rows in all, shared out by
    the largest remainder of the training rows. Runs over one row per label."""
    everyone = Window.partitionBy()
    n = F.sum("n").over(everyone)
    train = n - F.ceil(n * test_percent / 100.0)
    exact = F.col("n") * train / n
    sized = label_counts.select("label", "n", train.alias("train"), exact.alias("exact"))
    sized = sized.withColumn("base", F.floor("exact"))
    by_remainder = F.row_number().over(everyone.orderBy(F.desc(F.col("exact") - F.col("base")), "label"))
    spare = F.col("train") - F.sum("base").over(everyone)
    sized = sized.withColumn("extra", (by_remainder <= spare).cast("bigint"))
    return sized.select("label", (F.col("n") - F.col("base") - F.col("extra")).alias("n_test"))


def split_thresholds(
    docs: DataFrame, key: str = "id", label: str = "label", test_percent: int = TEST_SHARE_PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per label: the hash up to which a row belongs to the test set.

    The first rows of each label in hash order are the test set. Ranking a whole label would put
    it into one task, so the cut is located in two steps that read only key and label: a histogram
    of hash prefixes (at most 65,536 cells per label) tells which cell the cut falls into, then
    the counts of the hashes in that one cell tell where. Rows sharing a key share a hash; they are
    counted together before the shuffle and stay on one side.
    """
    hashed = docs.select(F.col(label).alias("_label"), split_hash(F.col(key), seed).alias("_h")).withColumn(
        "_cell", F.substring("_h", 1, _CELL_DIGITS)
    )
    cells = hashed.groupBy("_label", "_cell").agg(F.count(F.lit(1)).alias("n"))
    sizes = split_sizes(cells.groupBy(F.col("_label").alias("label")).agg(F.sum("n").alias("n")), test_percent)
    upto = F.sum("n").over(Window.partitionBy("_label").orderBy("_cell"))
    cut = (
        cells.withColumn("upto", upto)
        .join(F.broadcast(sizes.withColumnRenamed("label", "_label")), "_label")
        .filter((F.col("upto") >= F.col("n_test")) & (F.col("upto") - F.col("n") < F.col("n_test")))
        .select("_label", "_cell", (F.col("n_test") - F.col("upto") + F.col("n")).alias("take"))
    )
    within = hashed.join(F.broadcast(cut), ["_label", "_cell"]).groupBy("_label", "take", "_h").agg(
        F.count(F.lit(1)).alias("n")
    )
    reached = F.sum("n").over(Window.partitionBy("_label").orderBy("_h")) >= F.col("take")
    last = F.min(F.when(F.col("reached"), F.col("_h"))).alias("last_test_hash")
    return within.withColumn("reached", reached).groupBy("_label").agg(last)


def apply_split(
    docs: DataFrame, thresholds: DataFrame, key: str = "id", label: str = "label", seed: int = SEED
) -> DataFrame:
    """Adds ``split`` by comparing each row's hash with its label's threshold; no shuffle."""
    placed = docs.join(F.broadcast(thresholds), F.col(label) == F.col("_label"), "left")
    in_test = split_hash(F.col(key), seed) <= F.col("last_test_hash")
    split = F.when(in_test, F.lit("test")).otherwise(F.lit("train"))
    return placed.select(*docs.columns, split.alias("split"))


def stratified_split(
    docs: DataFrame, key: str = "id", label: str = "label", test_percent: int = TEST_SHARE_PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Adds ``split`` ("test" / "train"): exact share per label, repeatable for a seed."""
    return apply_split(docs, split_thresholds(docs, key, label, test_percent, seed), key, label, seed)


def fit_vocabulary(train: DataFrame, max_features: int = MAX_FEATURES, key: str = "id") -> DataFrame:
    """The indexed vocabulary of the training rows."""
    frequencies = durable(document_frequency(term_counts(train, keep=(key,)), train))
    return index_vocabulary(vocabulary_topn(frequencies, max_features))


def train_naive_bayes(vectors: DataFrame, indexed: DataFrame, alpha: float = NB_ALPHA) -> DataFrame:
    """Per term the smoothed log probabilities of both classes; pure aggregation."""
    entries = vectors.select("label", F.inline("entries"))
    of_class = {c: F.sum(F.when(F.col("label") == c, F.col("weight"))).alias(f"sum_{c}") for c in (0, 1)}
    sums = entries.groupBy("idx").agg(*of_class.values())
    terms = durable(
        indexed.join(sums, "idx", "left").select(
            "term", "idf", *[F.coalesce(F.col(f"sum_{c}"), F.lit(0.0)).alias(f"sum_{c}") for c in (0, 1)]
        )
    )
    size = terms.agg(F.count(F.lit(1))).scalar()
    log_prob = [
        F.log((F.col(f"sum_{c}") + alpha) / (terms.agg(F.sum(f"sum_{c}")).scalar() + alpha * size)).alias(f"log_prob_{c}")
        for c in (0, 1)
    ]
    return terms.select("term", "idf", *log_prob)


def class_log_prior(train: DataFrame) -> DataFrame:
    """One row: log share of each class."""
    n = F.count(F.lit(1))
    return train.agg(
        *[F.log(F.try_divide(F.count_if(F.col("label") == c), n)).alias(f"log_prior_{c}") for c in (0, 1)]
    )


def naive_bayes_model(log_probs: DataFrame, log_prior: DataFrame) -> DataFrame:
    """The two-class log ratio as a linear model table."""
    terms = log_probs.select(
        "term", "idf", (F.col("log_prob_1") - F.col("log_prob_0")).alias("coefficient")
    )
    intercept = log_prior.select(
        F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("idf"),
        (F.col("log_prior_1") - F.col("log_prior_0")).alias("coefficient"),
    )
    return terms.unionByName(intercept)


_VECTORS = StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])


def vector_table(vectors: DataFrame, size: int) -> DataFrame:
    """(label, features) with sparse vectors, as the estimators of pyspark.ml take them. A vector is stored as a
    struct of its kind, size, indices and values; the struct is put together by column expressions, written, and
    read as a vector."""
    sparse = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.transform("entries", lambda e: e["idx"]).alias("indices"),
        F.transform("entries", lambda e: e["weight"]).alias("values"),
    )
    return durable(vectors.select(F.col("label").cast("double").alias("label"), sparse.alias("features")), _VECTORS)


def train_logistic_regression(
    vectors: DataFrame, indexed: DataFrame, c: float = LR_C, max_iter: int = LR_MAX_ITER, tolerance: float = LR_TOLERANCE
) -> DataFrame:
    """L2-regularised logistic regression over the document vectors, as a linear model table.

    The objective is half the squared coefficients plus C times the summed loss; the intercept carries no penalty.
    The coefficients pass the driver; the vocabulary cap bounds them.
    """
    fitted, bias = logistic.fit(vectors, indexed.count(), c, max_iter, tolerance)
    spark = vectors.sparkSession
    coefficients = spark.createDataFrame(list(enumerate(fitted.tolist())), "idx int, coefficient double")
    terms = indexed.join(coefficients, "idx").select(*MODEL_COLUMNS)
    intercept = spark.createDataFrame([(None, None, bias)], "term string, idf double, coefficient double")
    return terms.unionByName(intercept)


def logistic_regression_gradient(vectors: DataFrame, indexed: DataFrame, model: DataFrame, c: float = LR_C) -> DataFrame:
    """(term, idf, gradient) of the stated objective, the penalty plus C times the summed loss, at the model's
    coefficients; the row without a term is the intercept. All are near 0 at the optimum."""
    rows = durable(vectors.select("label", "entries", F.monotonically_increasing_id().alias("_row")))
    weights = durable(indexed.join(model, "term").select("idx", "term", indexed["idf"], "coefficient"))
    entries = rows.select("_row", F.inline("entries"))
    margins = entries.join(weights, "idx").groupBy("_row").agg(F.sum(F.col("weight") * F.col("coefficient")).alias("margin"))
    intercept = model.filter(F.col("term").isNull()).select("coefficient").scalar()
    margin = F.coalesce("margin", F.lit(0.0)) + intercept
    errors = durable(
        rows.join(margins, "_row", "left").select("_row", (1.0 / (1.0 + F.exp(-margin)) - F.col("label")).alias("error"))
    )
    with_error = rows.join(errors, "_row").select("error", F.inline("entries"))  # joined as rows, not as entries
    sums = with_error.groupBy("idx").agg(F.sum(F.col("weight") * F.col("error")).alias("slope"))
    of_terms = weights.join(sums, "idx", "left").select(
        "term", "idf", (F.col("coefficient") + c * F.coalesce("slope", F.lit(0.0))).alias("gradient")
    )
    of_intercept = errors.select(
        F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("idf"), (c * F.col("error")).alias("e")
    ).groupBy("term", "idf").agg(F.sum("e").alias("gradient"))
    return of_terms.unionByName(of_intercept)


def predict_sentiment(
    docs: DataFrame, model: DataFrame, key: str = "id", text: str = "cleaned_text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Key, kept columns, label, sentiment and both probabilities for every document.

    Pass a written model (``durable`` or ``read_model``), whose size the planner knows.

    Narrow columns named in ``keep`` ride along through the one small shuffle, so tagging before
    scoring and keeping the flags avoids moving any text. A tie is class 0.
    """
    scores = score_documents(docs, model.filter(F.col("term").isNotNull()), text, (key, *keep))
    intercept = model.filter(F.col("term").isNull()).select("coefficient").scalar()
    margin = F.col("margin") + intercept
    positive = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    scored = scores.select(
        key, *keep, (margin > 0).cast("int").alias("predicted_label"), positive.alias("prob_positive")
    )
    return scored.select(
        key, *keep, "predicted_label", label_to_sentiment().alias("predicted_sentiment"),
        (F.lit(1.0) - F.col("prob_positive")).alias("prob_negative"), "prob_positive",
    )


def attach_predictions(posts: DataFrame, predictions: DataFrame, key: str = "id") -> DataFrame:
    """Wide posts with their predictions; needed only where the text itself must be kept."""
    return posts.join(predictions, key, "left")


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Label x prediction counts, both classes always present."""
    cells = {
        (a, b): F.count_if((F.col("label") == a) & (F.col("predicted_label") == b)).alias(f"n{a}{b}")
        for a in (0, 1) for b in (0, 1)
    }
    flat = scored.agg(*cells.values())
    rows = [
        F.struct(F.lit(a).alias("label"), F.col(f"n{a}0").alias("predicted_0"), F.col(f"n{a}1").alias("predicted_1"))
        for a in (0, 1)
    ]
    return flat.select(F.inline(F.array(*rows)))


def classification_metrics(scored: DataFrame) -> DataFrame:
    """Long (scope, precision, recall, f1, support, accuracy): each class, macro and weighted.

    All from four counts of one aggregate; an undefined ratio is 0.
    """
    def count(a, b):
        return F.count_if((F.col("label") == a) & (F.col("predicted_label") == b))

    flat = scored.agg(*[count(a, b).cast("double").alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)])

    def ratio(num: Column, den: Column) -> Column:
        return F.coalesce(F.try_divide(num, den), F.lit(0.0))

    per_class = {}
    for c in (0, 1):
        hit, miss, wrong = F.col(f"n{c}{c}"), F.col(f"n{c}{1 - c}"), F.col(f"n{1 - c}{c}")
        precision, recall = ratio(hit, hit + wrong), ratio(hit, hit + miss)
        per_class[c] = (precision, recall, ratio(2.0 * hit, 2.0 * hit + miss + wrong), hit + miss)
    total = per_class[0][3] + per_class[1][3]
    accuracy = ratio(F.col("n00") + F.col("n11"), total)

    def row(scope: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(scope).alias("scope"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("bigint").alias("support"), accuracy.alias("accuracy"),
        )

    macro = [(per_class[0][i] + per_class[1][i]) / 2.0 for i in range(3)]
    weighted = [
        ratio(per_class[0][i] * per_class[0][3] + per_class[1][i] * per_class[1][3], total) for i in range(3)
    ]
    return flat.select(
        F.inline(
            F.array(
                row("negative", *per_class[0]), row("positive", *per_class[1]),
                row("macro avg", *macro, total), row("weighted avg", *weighted, total),
            )
        )
    )


def model_selection(scored_by_model: dict[str, DataFrame]) -> DataFrame:
    """Accuracy and positive-class F1 per model, and which one has the best accuracy; in a tie the
    model named first, the default scorer."""
    rows = None
    for place, (name, scored) in enumerate(scored_by_model.items()):
        metrics = classification_metrics(scored).filter(F.col("scope") == "positive")
        one = metrics.select(
            F.lit(name).alias("model"), "accuracy", F.col("f1").alias("f1_positive"), F.lit(-place).alias("_first")
        )
        rows = one if rows is None else rows.unionByName(one)
    best = F.max_by("model", F.struct("accuracy", "_first")).over(Window.partitionBy())
    return rows.select("model", "accuracy", "f1_positive", (F.col("model") == best).alias("selected"))
