"""URL filters: policy rules by host and path, and a large list of canonical URLs.

The list becomes a blocked Bloom filter of bounded size. It is probed where the pages are; only the
pages that may be listed are moved, to an exact hash join with the list, which removes the filter's
false positives. So the cost of a list follows its hits, not the pages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm import bloom
from moodtide.llm.common import ascii_lower
from moodtide.session import durable


@dataclass(frozen=True)
class UrlRule:
    """``site`` is a host, then a path that begins with a slash; the rule holds for the host, all its
    subdomains, and every path that begins with the rule's."""

    verdict: str
    site: str

    @property
    def host(self) -> str:
        return self.site.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.site[len(self.host) :]


RULES = (
    UrlRule("allow", "org/"),
    UrlRule("block", "example.org/es/"),
    UrlRule("block", "example.org/en/1"),
    UrlRule("allow", "com/fr/"),
    UrlRule("block", "com/de/"),
)


def _rest(url: str) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(F.col(url), "://")
    return F.coalesce(F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))), F.lit(""))


def host_of(url: str) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: str) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """One spelling for the URLs of a page: no scheme, query or fragment, default port or last slash."""
    return F.concat(F.regexp_replace(host, r":(80|443)$", ""), F.regexp_replace(path, r"/$", ""))


def first_rule(rules: tuple[UrlRule, ...], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that holds, else null. One condition per rule: for policies of up to a
    few hundred rules; longer lists of single pages belong in the list of URLs."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.site)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        chosen = F.when(fits & path.startswith(rule.path), F.lit(value(rule))).otherwise(chosen)
    return chosen


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: tuple[UrlRule, ...] = RULES, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per page: page_id, host, path, rule, listed, verdict.

    ``listed`` has a column ``url``. The longest rule that holds decides; without one, a page is blocked
    if its canonical URL is that of a listed one, else allowed. ``listed`` is null where a rule decided.

    Null URLs and those without ``://`` have an empty host and path; no rule holds and they are never
    listed. Null or repeated keys and repeated URLs give a row each. Listed URLs may be null (ignored)
    or repeated. Empty pages give no rows, an empty list blocks nothing. Other columns are ignored.
    """
    host, path = F.col("host"), F.col("path")
    judged = pages.select(F.col(key).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")).select(
        "*", canonical(host, path).alias("canonical"), first_rule(rules, host, path, lambda r: r.site).alias("rule"),
        first_rule(rules, host, path, lambda r: r.verdict).alias("rule_verdict"),
    )
    names = listed.select(canonical(host_of("url"), path_of("url")).alias("canonical")).filter(F.col("canonical") != "")
    names = durable(names.distinct())
    filled = bloom.build(names.select(F.xxhash64("canonical").alias("h")), names.count())
    open_question = F.col("rule").isNull() & (host != "")
    probed = durable(judged.withColumn("may", open_question & bloom.may_contain(judged, filled, F.xxhash64("canonical"))))
    exact = probed.filter("may").join(
        names.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "canonical", "left"
    ).withColumn("listed", F.coalesce("listed", F.lit(False)))
    others = probed.filter(~F.col("may")).withColumn("listed", F.when(F.col("rule").isNull(), F.lit(False)))
    verdict = F.coalesce("rule_verdict", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    columns = ["page_id", "host", "path", "rule", "listed", verdict.alias("verdict")]
    return exact.select(columns).unionByName(others.select(columns))
