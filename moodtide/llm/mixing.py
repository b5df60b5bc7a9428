"""Mixing sources to target weights by hash thresholds.

Every row has a fixed place in [0, 2^60), the hash of its id. For each source the mix takes all rows
below a threshold, chosen so that the sizes taken come to the source's budget: sizes are summed by
source and hash bucket, the bucket in which the running sum crosses the budget is found, and only that
bucket is refined, digit by digit, down to single rows. No row is sorted or ranked; the histograms
have at most sources x 2^16 rows. A larger budget gives a larger threshold, so mixes are nested.

Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.llm.common import n_words
from moodtide.session import durable

#: Digits, in bits, of the 60-bit place of a row, from the first histogram to the last.
DIGITS = (12, 16, 16, 16)
BITS = sum(DIGITS)
WEIGHTS = (3, 1, 2)
#: The mix has SHARE[0] / SHARE[1] of all sizes; no source gives more than CAP times its size.
SHARE, CAP = (3, 2), 2


def place(doc_id: Column | str) -> Column:
    """The fixed place of an id: the first 60 bits of its MD5; a null id counts as empty text."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _tie(value: Column) -> Column:
    return F.xxhash64(value).bitwiseAND((1 << BITS) - 1)


def sized(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """(doc_id, source, size, place, tie, number) of every row, written once. Size: number of words; null text 0.

    ``tie``, of the text, tells rows of one id apart, ``number`` only rows of one id and text; it is stored, so
    all later steps see the same value.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size"),
        place(doc_id).alias("place"), _tie(F.col(text).cast("string")).alias("tie"), _tie(F.monotonically_increasing_id()).alias("number"),
    )
    return durable(rows)


def target_sizes(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, cap: int = CAP
) -> DataFrame:
    """(source, source_size, target): the budget shared out by weight, stopped at ``cap`` times a source's size.

    Sources take the weights in turn, in code-point order, null last. What a stopped source cannot take is
    shared again among the others: in the order of cap over weight the stopped sources come first, so running
    sums decide. One row per source is all that the windows see. Whole numbers are compared exactly.
    """
    sources = durable(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    everything, by_code = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_code) - 1) % len(weights) + 1))
    weighed = sources.select("source", "source_size", weight.cast("long").alias("weight")).select(
        "*", F.sum("source_size").over(everything).alias("total"), F.sum("weight").over(everything).alias("weights")
    )
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    running = weighed.select(
        "*", F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    )
    num, den = share

    def big(x: Column) -> Column:
        return x.cast("decimal(19,0)")

    left = num * F.col("total") - den * cap * F.col("size_before")
    stopped = big(left) * big(F.col("weight")) >= big(den * cap * F.col("source_size")) * big(F.col("weights") - F.col("weight_before"))
    flagged = running.select("*", stopped.alias("stopped"))
    spent = F.sum(F.when(F.col("stopped"), F.col("source_size")).otherwise(0)).over(everything)
    free = F.sum(F.when(F.col("stopped"), 0).otherwise(F.col("weight"))).over(everything)
    fair = (num * F.col("total") - den * cap * spent).cast("double") * F.col("weight") / (den * free)
    target = F.when(F.col("stopped"), (cap * F.col("source_size")).cast("double")).otherwise(fair)
    return flagged.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source: source_size, target, whole (times that every row is taken), and the cut
    (cut_place, cut_tie, take_cut) below which rows are taken once more, with what rows at the cut are to add.

    The row at the cut is taken if that brings the sum nearer to the budget. Sources without any words
    have no cut.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budgets = targets.select("*", whole.cast("int").alias("whole"))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    state = durable(
        budgets.select("*", rest.alias("rest"), F.lit(0).cast("long").alias("cut_place"), F.lit(0).cast("long").alias("cut_tie"))
    )
    answer, active = state, sizes
    for key, shift, bits in _levels():
        digit = F.shiftright(F.col(key), shift).bitwiseAND((1 << bits) - 1)
        histogram = active.groupBy("source", digit.alias("digit")).agg(F.sum("size").alias("in_bucket"))
        before = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        running = histogram.withColumn("below", F.coalesce(F.sum("in_bucket").over(before), F.lit(0))).alias("h")
        crossing = running.join(state.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source"))).filter(
            (F.col("below") <= F.col("rest")) & (F.col("below") + F.col("in_bucket") > F.col("rest"))
        )
        cut = F.col(f"s.cut_{key}").bitwiseOR(F.shiftleft(F.col("digit").cast("long"), shift))
        state = durable(
            crossing.select(
                "s.source", "source_size", "target", "whole", (F.col("rest") - F.col("below")).alias("rest"),
                *[cut.alias(f"cut_{k}") if k == key else F.col(f"s.cut_{k}") for k in ("place", "tie")],
                (2 * (F.col("rest") - F.col("below")) >= F.col("in_bucket")).alias("take_cut"),
            )
        )
        boundary = state.select(F.col("source").alias("cut_source"), F.col(f"cut_{key}").alias("cut"))
        here = F.shiftright(F.col(key), shift) == F.shiftright("cut", shift)
        active = durable(active.join(boundary, F.col("source").eqNullSafe(F.col("cut_source")) & here, "left_semi"))
    cuts = state.select(F.col("source").alias("cut_source"), "cut_place", "cut_tie", "take_cut", F.col("rest").alias("rest_at_cut"))
    joined = answer.drop("cut_place", "cut_tie", "rest").join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    return durable(joined.drop("cut_source"))


def _levels() -> list[tuple[str, int, int]]:
    """(key, shift, bits) of each digit: first those of the place, then those of the tie."""
    found = []
    for key in ("place", "tie"):
        shift = BITS
        for bits in DIGITS:
            shift -= bits
            found.append((key, shift, bits))
    return found


def _times() -> Column:
    """How often the mix takes a row of size above 0."""
    at, cut = F.col("place"), F.col("cut_place")
    inside = (at < cut) | ((at == cut) & ((F.col("tie") < F.col("cut_tie")) | ((F.col("tie") == F.col("cut_tie")) & F.col("take_cut"))))
    return F.col("whole") + F.coalesce(inside, F.lit(False)).cast("int")


def _with_thresholds(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Attach each row's source; there is one row per source, whose table's size the planner knows."""
    cuts = cuts.withColumnRenamed("source", "cut_source")
    return rows.join(cuts, F.col("source").eqNullSafe(F.col("cut_source"))).drop("cut_source")


def _with_times(rows: DataFrame, sizes: DataFrame, cuts: DataFrame, number: Column) -> DataFrame:
    """``rows`` (source, size, place, tie and others) with source_size, target and ``times``.

    If the cut of a source falls on several rows that neither place nor tie tells apart, these rows are written
    and told apart by ``number``, so that as many of them are taken as the source needs. They are equal, so
    which ones does not matter.
    """
    at_cut = F.coalesce((F.col("place") == F.col("cut_place")) & (F.col("tie") == F.col("cut_tie")), F.lit(False))
    counted = durable(
        _with_thresholds(sizes, cuts).filter(at_cut).groupBy("source").agg(
            F.sum("size").alias("source_size"), F.first("rest_at_cut").alias("target"), F.count(F.lit(1)).alias("n")
        )
    )
    placed = _with_thresholds(rows, cuts)
    names = [*rows.columns, "source_size", "target"]
    if counted.filter("n > 1").isEmpty():
        return placed.select(*names, _times().alias("times"))
    before = [F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("whole").alias("_before")]
    equal = durable(placed.filter(at_cut).select(*[c for c in rows.columns if c != "tie"], number.alias("tie"), *before))
    again = _with_thresholds(equal, thresholds(equal.select("source", "size", "place", "tie"), counted.drop("n")))
    taken = again.select(*rows.columns, F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_before") + _times()).alias("times"))
    return placed.filter(~at_cut).select(*names, _times().alias("times")).unionByName(taken)


def mix(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, cap: int = CAP,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, times, taken (times x size).

    Each source's taken sizes differ from its target by at most half of one document. The same rows
    give the same mix, however they are partitioned.

    Null text: size 0. Null source: a source of its own. Null ids share one place; rows of one id are told
    apart by their text, and equal rows by a stored number, so a source of which a third has one id still
    meets its target. Very long texts are only counted. Documents
    without words are taken as often as any below the cut and add nothing. An empty table gives no rows.
    Other columns are ignored.
    """
    sizes = sized(docs, text, doc_id, source)
    cuts = thresholds(sizes, target_sizes(sizes, weights, share, cap))
    rows = _with_times(sizes, sizes, cuts, F.col("number"))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken")
    )


def mixed_rows(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, cap: int = CAP,
) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    The texts are filtered where they are; only narrow columns are aggregated. Rows of one id are told
    apart by a hash of their columns. If the cut of a source falls on fully equal rows, the rows at the cuts
    are written and told apart by a stored tie, so each source meets its target as in ``mix``.
    """
    tie = _tie(F.struct(*docs.columns))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(source).alias("source"), n_words(text).alias("size"),
        place(doc_id).alias("place"), tie.alias("tie"),
    )
    sizes = durable(
        docs.select(
            F.col(source).alias("source"), n_words(text).alias("size"), place(doc_id).alias("place"), tie.alias("tie")
        )
    )
    cuts = thresholds(sizes, target_sizes(sizes, weights, share, cap))
    times = _with_times(rows, sizes, cuts, _tie(F.monotonically_increasing_id())).select("row", "times")
    return times.select("row", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("copy")).select("row.*")
