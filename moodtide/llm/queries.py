"""The registered queries of the training-data operators, and the SQL they are checked with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.llm import bpe, exact_dedup, language_id, mixing, near_dedup, quality, secret_scan, token_files, toxicity, url_filter
from moodtide.llm import structure_queries  # noqa: F401 - registers its queries
from moodtide.llm.common import id_remainder, table
from moodtide.llm.registry import ORACLES, QUERIES, query  # noqa: F401 - ORACLES and QUERIES are read from here
from moodtide.session import scratch_path

#: Sites whose pages make up the list of URLs that op7 blocks.
LISTED_SITES = ("ads-track", "spam-farm", "casino-win", "adult-x", "free-bets")


def hex_sha256(text: Column | str) -> Column:
    return F.sha2((F.col(text) if isinstance(text, str) else text).cast("binary"), 256)


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_and_check(table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        hex_sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"), "decoded_sha256",
    )


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_OP3_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
places AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS p FROM d WHERE len(w) >= 5),
windows AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p : p + 4]) AS n FROM places),
covered AS (SELECT doc_id, count(DISTINCT p + k) AS n_repeat_words FROM windows, generate_series(0, 4) AS s(k)
  WHERE n > 1 GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(l) AS n_lines,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > n_words
    OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)) AS kept
FROM v"""


@query("op3_quality", _OP3_SQL)
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")), quality.V1)
    base = F.col("failed").bitwiseAND(quality.BASE.mask(quality.RULES)) != 0
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept"
    )


_OP4_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS}) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS ss, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
r AS (SELECT *, sum(ss) OVER () AS total, sum(w) OVER () AS ws,
    coalesce(sum(ss) OVER before, 0) AS ss_before, coalesce(sum(w) OVER before, 0) AS w_before
  FROM s WINDOW before AS (ORDER BY CAST(ss AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, (3 * total - 4 * ss_before) * w >= 4 * ss * (ws - w_before) AS stopped FROM r),
g AS (SELECT *, coalesce(sum(ss) FILTER (stopped) OVER (), 0) AS spent, coalesce(sum(w) FILTER (NOT stopped) OVER (), 0) AS free FROM f),
t AS (SELECT source, ss, CASE WHEN stopped THEN CAST(2 * ss AS DOUBLE)
    ELSE CAST(3 * total - 4 * spent AS DOUBLE) * w / (2 * free) END AS target FROM g),
b AS (SELECT *, CASE WHEN ss > 0 THEN CAST(floor(target / ss) AS INTEGER) ELSE 0 END AS whole FROM t),
c AS (SELECT d.*, ss, target, whole, target - whole * ss AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY place ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, ss AS source_size, target,
  size * (whole + CASE WHEN upto <= rest OR (upto - size <= rest AND 2 * (rest - (upto - size)) >= size)
    THEN 1 ELSE 0 END) AS taken
FROM c"""


@query("op4_mixing", _OP4_SQL)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))

    def number(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, secret_scan.BASE_KINDS), hex_sha256(secret_scan.spans_text(base)).alias("base_sha256"),
        secret_scan.spans_text(F.col("secrets")).alias("spans"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(
    "op6_exact_dedup",
    f"""WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
      text_sha256 FROM d WINDOW w AS (PARTITION BY text_sha256)""",
)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return resolved.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _op7_sql() -> str:
    rules = sorted(url_filter.RULES, key=lambda r: -len(r.site))
    cases = {
        field: " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, field)}'"
            for r in rules
        )
        for field in ("site", "verdict")
    }
    sites = " OR ".join(f"contains('.' || host, '.{s}.')" for s in LISTED_SITES)
    return rf"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
c AS (SELECT *, regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/$', '') AS canonical FROM h),
l AS (SELECT DISTINCT canonical FROM c WHERE {sites}),
j AS (SELECT page_id, host, path, CASE {cases['site']} END AS rule, CASE {cases['verdict']} END AS rule_verdict,
    canonical IN (SELECT canonical FROM l) AS listed FROM c)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict FROM j"""


@query("op7_url_filter", _op7_sql())
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: the URLs of all pages on advertising, gambling and similar sites."""
    pages = table(spark, sf_dir, "pages")
    site = F.concat(F.lit("."), url_filter.host_of("url"))
    on_site = site.contains(f".{LISTED_SITES[0]}.")
    for name in LISTED_SITES[1:]:
        on_site = on_site | site.contains(f".{name}.")
    judged = url_filter.filter_urls(pages, pages.filter(on_site).select("url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_files.read_token_files(spark, path)


def is_held_out(divisor: int, remainder: int) -> Column:
    return id_remainder("doc_id", divisor) == remainder


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~is_held_out(4, 2)))
    return language_id.predict(docs, model).withColumn("held_out", is_held_out(4, 2))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    """The model learned from the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(~is_held_out(5, 0))
    return toxicity.train(table(spark, sf_dir, "documents"), labels)


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.withColumn("held_out", is_held_out(5, 0))


@query("op1_near_dedup")
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of two words, as the query's contract has it."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=2)
