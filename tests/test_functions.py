from __future__ import annotations

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from moodtide.config import DEFAULT_TOPICS, Study, Topic
from moodtide.functions import dates, numeric, text
from moodtide.functions.topics import keyword_hits, matched_keywords, prepare_keywords, topic_flag

MESSY = [
    "@éabc hi", "a b", "HTTP://X.y z http", "x\x1cy z", "@a_b1 c@d.e", "http foo", "İstanbul",
    "https://only.example/x", "\U0001f600\U0001f601", "  Two   Words\n\nthree ", "@@ab 12 @ cd", "", "K and Kelvin",
    "no@http://u.v w", "trailing http", "日本語 text　wide", "tab\tsep\x85nel",
]


def expected_clean(s: str) -> str:
    """The definition in the words of Python's own Unicode-aware patterns."""
    for pattern in (r"http\S+", r"@\w+", r"[^a-z\s]"):
        s = re.sub(pattern, "", s.lower())
    return " ".join(s.split())


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_clean_text_on_messy_strings(spark):
    assert column(spark, MESSY, text.clean_text) == [expected_clean(s) for s in MESSY]


def test_clean_text_on_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", text.clean_text(F.col("text")).alias("c"))
    assert all(r["c"] == expected_clean(r["text"]) for r in docs.collect())


def test_keyword_cleaning_agrees_with_column_cleaning(spark):
    words = [k for t in DEFAULT_TOPICS for k in t.keywords] + MESSY
    assert [text.clean_keyword(w) for w in words] == column(spark, words, text.clean_text)


def test_strip_covers_all_whitespace(spark):
    values = [w + "a b" + w for w in text.WHITESPACE]
    assert column(spark, values, text.strip_whitespace) == [v.strip() for v in values]


def test_placeholders(spark):
    values = [None, "[Deleted]", " null ", "NaN", "none", "None of it", " a \n b ", "[removed]", "AutoModerator"]
    assert column(spark, values, text.normalize_text_placeholders) == [
        "", "", "", "", "", "None of it", "a b", "", "AutoModerator",
    ]
    authors = ["AutoModerator", "[deleted]", "None", None, " MixedCase ", "null"]
    assert column(spark, authors, text.normalize_author) == ["", "", "", "", "mixedcase", "null"]


def test_null_literals_are_case_sensitive(spark):
    assert column(spark, ["NA", "na", "None", "none", "", "x"], text.null_literals) == [None, "na", None, "none", None, "x"]


def test_coerce_double(spark):
    values = ["1.5e9", " 12 ", "abc", None, "1d", "2.5F", "nan", "-3"]
    assert column(spark, values, numeric.coerce_double) == [1.5e9, 12.0, None, None, None, None, None, -3.0]


def test_year_range_edges(spark):
    values = [
        "1483228799", "1483228800", "1767225599", "1767225600", "abc", None, "inf", "-inf", "nan", "1e300",
        "1483228800.9", "1.5e9",
    ]
    inside = column(spark, values, lambda c: dates.epoch_in_years(c, 2017, 2025))
    assert inside == [False, True, True, False, False, False, False, False, False, False, True, True]


def test_epoch_to_timestamp_limits(spark):
    values = ["0", "1e300", "abc", "9223372036", "9223372037"]
    stamps = column(spark, values, lambda c: dates.epoch_to_timestamp(c).isNotNull())
    assert stamps == [True, False, False, True, False]


@pytest.mark.parametrize("name,year", [("pre-COVID", 2019), ("COVID", 2020), ("post-COVID", 2031), ("outside-study-range", 2016), ("unknown", None)])
def test_default_periods(spark, name, year):
    df = spark.createDataFrame([(year,)], "y int")
    assert df.select(dates.assign_time_period(F.col("y"), Study().periods)).first()[0] == name


def test_normal_cdf_matches_math(spark):
    xs = [x / 16.0 for x in range(-160, 161)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i")
    got = [r[0] for r in df.select(numeric.normal_cdf(F.col("x"))).collect()]
    want = [0.5 * (1.0 + math.erf(x / math.sqrt(2.0))) for x in xs]
    assert max(abs(a - b) for a, b in zip(got, want)) < 1e-14


def test_normal_cdf_is_compiled_and_exact_at_the_seams(spark):
    seams = [s * math.sqrt(2.0) + d for s in (0.0, 0.46875, 4.0, 6.0) for d in (-1e-9, 0.0, 1e-9)]
    xs = [None, math.nan, math.inf, -math.inf, *seams, *(-x for x in seams)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    cdf = df.select("i", numeric.normal_cdf(F.col("x")).alias("cdf"), numeric.p_value_two_sided(F.col("x")).alias("p"))
    assert "lambda" not in cdf._jdf.queryExecution().optimizedPlan().toString()  # no loop for each row
    got = [r["cdf"] for r in cdf.orderBy("i").collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:4] == [1.0, 0.0]
    assert max(abs(a - 0.5 * math.erfc(-x / math.sqrt(2.0))) for a, x in zip(got[4:], xs[4:])) < 1e-15


def z(spark, *counts):
    df = spark.createDataFrame([counts], "a long, b long, c long, d long")
    t = numeric.two_proportion_z_test(*[F.col(c) for c in "abcd"])
    return df.select(t.rate_a, t.rate_b, t.difference, t.z, t.p).first()


def test_published_z_value(spark):
    row = z(spark, 12332, 55092, 728883, 1480721)
    assert row[3] == pytest.approx(-123.79261996748677, rel=1e-12) and row[4] == 0.0


def test_z_test_degenerate(spark):
    assert list(z(spark, 0, 0, 1, 2)) == [None] * 5
    assert list(z(spark, 3, 3, 2, 2)) == [1.0, 1.0, 0.0, None, None]


def test_guarded_correlation(spark):
    def corr(rows):
        df = spark.createDataFrame(rows, "x double, y double")
        return df.agg(numeric.guarded_correlation(F.col("x"), F.col("y"))).first()[0]

    assert corr([(1.0, 2.0)]) is None
    assert corr([(0.1, 2.0), (0.1, 3.0), (0.1, 5.0)]) is None
    complete = corr([(1.0, 1.0), (2.0, 3.0), (4.0, 4.0)])
    assert corr([(1.0, 1.0), (2.0, 3.0), (3.0, None), (None, 4.0), (4.0, 4.0)]) == pytest.approx(complete)


def test_prepared_keyword_counts():
    sizes = {t.name: len(prepare_keywords(t)) for t in DEFAULT_TOPICS}
    assert list(sizes.values()) == [15, 26, 17, 11, 10, 13] and sum(len(t.keywords) for t in DEFAULT_TOPICS) == 94
    assert "onsite" in [k.raw for k in prepare_keywords(DEFAULT_TOPICS[1])]
    assert "on-site" not in [k.raw for k in prepare_keywords(DEFAULT_TOPICS[1])]


def test_production_topics(spark):
    posts = [
        "They laid-off everyone, then a HIRING   freeze!",
        "payment is not a match for that keyword",
        "base pay, on-site or on site, return-to-office",
        "",
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(posts)], "i int, p string")
    hits = df.withColumn("h", keyword_hits(text.clean_text(F.col("p")), DEFAULT_TOPICS)).orderBy("i")
    topics = {t.name: t for t in DEFAULT_TOPICS}
    flags = [[r[0], r[1]] for r in hits.select(
        topic_flag(F.col("h"), topics["layoffs_market"]), topic_flag(F.col("h"), topics["compensation"])).collect()]
    assert flags == [[1, 0], [0, 0], [0, 1], [0, 0]]
    words = [tuple(r) for r in hits.select(
        matched_keywords(F.col("h"), topics["layoffs_market"]), matched_keywords(F.col("h"), topics["work_mode"]),
        matched_keywords(F.col("h"), topics["compensation"])).collect()]
    assert words[0] == ("hiring freeze; laid-off", "", "")
    assert words[2] == ("", "on site; onsite; return-to-office", "base pay; pay")


def test_long_keyword_lists_find_what_each_keyword_finds(spark, sf_dir):
    """Thousands of words and phrases of up to four words, met from the text's side."""
    from moodtide.catalog import fixtures as fx

    texts = [r[0] or "" for r in fx.cleaned_docs(spark, sf_dir).select("cleaned_text").limit(60).collect()]
    texts += ["", "a", "a a a", "a  a", "the end of the"]
    present = {" ".join(t.split()[i : i + n]) for t in texts[:40] for n in (1, 2, 3, 4) for i in range(0, len(t.split()) - n + 1, 3)}
    absent = {f"{p} zq" for p in list(sorted(present))[:500]} | {"a a", "end of the"}
    phrases = sorted(p for p in present | absent if p)
    topic = Topic("long", "d", tuple(p.upper() if i % 2 else p for i, p in enumerate(phrases)))
    keywords = prepare_keywords(topic)
    assert len(keywords) > 1000
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i int, c string")
    found = df.withColumn("h", keyword_hits(F.col("c"), (topic,))).select(
        "i", "h", topic_flag(F.col("h"), topic).alias("flag"), matched_keywords(F.col("h"), topic).alias("words"))
    for i, hits, flag, words in found.collect():
        expected = [k for k in keywords if i >= 0 and f" {k.cleaned} " in f" {texts[i]} "]
        assert sorted(hits) == sorted(k.cleaned for k in expected) and flag == bool(expected)
        assert words == "; ".join(k.raw for k in sorted(expected, key=lambda k: k.raw.lower()))


def test_topic_without_usable_keywords(spark):
    empty = Topic("odd", "d", ("@all", "123"))
    df = spark.createDataFrame([("any text",)], "c string")
    h = keyword_hits(F.col("c"), (empty,))
    assert df.select(topic_flag(h, empty), matched_keywords(h, empty)).first()[:] == (0, "")


def test_split_hash_is_plain_md5(spark):
    from moodtide.operators.models import split_hash

    got = spark.createDataFrame([("7",)], "id string").select(split_hash(F.col("id"))).first()[0]
    assert got == hashlib.md5(b"7:42").hexdigest()
