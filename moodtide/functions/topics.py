"""Keyword matching over cleaned text.

Cleaned text holds only ``a-z`` words with single blanks, so "keyword as a whole word or phrase"
is word membership for single words and a blank-padded substring for phrases. All single words of
all topics are looked up with one hash intersection over the text's words; phrases are a codegen'd
substring test each. Both grow with the list, so from ``MANY`` keywords on the text's own words and
phrases of the lengths that occur are looked up in hash sets instead: the cost per post is then that
of its words, however long the list.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodtide.config import Topic
from moodtide.functions.text import clean_keyword


#: Keywords from which on the text is looked up in the list instead of the list in the text; the hits are the same.
MANY = 200


@dataclass(frozen=True)
class Keyword:
    position: int
    raw: str
    cleaned: str


def prepare_keywords(topic: Topic) -> tuple[Keyword, ...]:
    """Cleaned keywords of one topic: empty ones dropped, the first spelling kept for each."""
    by_cleaned: dict[str, Keyword] = {}
    for position, raw in enumerate(topic.keywords):
        cleaned = clean_keyword(raw)
        if cleaned:
            by_cleaned.setdefault(cleaned, Keyword(position, raw, cleaned))
    return tuple(by_cleaned.values())


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def contains_phrase(text: Column, phrase: str) -> Column:
    """Whole-word occurrence of a cleaned phrase in cleaned text."""
    return F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.lit(f" {phrase} "))


def _among(value: Column, values: list[str]) -> Column:
    """Membership in a hash set that is built once per task."""
    return value.isin(*values)


def listed_phrases(text: Column, keywords: list[str]) -> Column:
    """The distinct cleaned keywords that occur in the cleaned text, found from the text's side: where a word begins
    some keyword, the phrases of each length that occurs are made and looked up."""
    lengths = sorted({k.count(" ") + 1 for k in keywords})
    beginnings = sorted({k.split(" ", 1)[0] for k in keywords})

    def found(words: Column) -> Column:
        size = F.size(words)
        starts = F.filter(F.sequence(F.lit(1), size), lambda i: _among(F.get(words, i - 1), beginnings))

        def phrases(at: Column) -> Column:
            by_length = [
                F.transform(F.filter(at, lambda i: i + n - 1 <= size), lambda i: F.array_join(F.slice(words, i, n), " "))
                for n in lengths
            ]
            return F.filter(F.array_distinct(F.concat(*by_length)), lambda p: _among(p, keywords))

        return _with(starts, phrases)

    return _with(F.split(text, " "), found)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once: inside a higher-order function it would be for every element."""
    return F.get(F.transform(F.array(value), use), 0)


def keyword_hits(text: Column, topics: tuple[Topic, ...]) -> Column:
    """Distinct cleaned keywords of any topic that occur in the cleaned text."""
    cleaned = sorted({k.cleaned for topic in topics for k in prepare_keywords(topic)})
    if len(cleaned) >= MANY:
        return F.coalesce(listed_phrases(text, cleaned), _strings([]))
    words = [k for k in cleaned if " " not in k]
    phrases = [k for k in cleaned if " " in k]
    hits = F.array_intersect(_strings(words), F.split(text, " "))
    if phrases:
        found = F.array(*[F.when(contains_phrase(text, p), F.lit(p)) for p in phrases])
        hits = F.concat(hits, F.array_compact(found))
    return F.coalesce(hits, _strings([]))


def topic_flag(hits: Column, topic: Topic) -> Column:
    """1 if any keyword of the topic is among the hits."""
    keywords = [k.cleaned for k in prepare_keywords(topic)]
    if len(keywords) >= MANY:
        return F.exists(hits, lambda h: _among(h, keywords)).cast("int")
    return F.arrays_overlap(hits, _strings(keywords)).cast("int") if keywords else F.lit(0)


def matched_keywords(hits: Column, topic: Topic) -> Column:
    """Configured spellings of the topic's hits, sorted, joined with "; ".

    The sorting is done here while the plan is built, not per row.
    """
    keywords = sorted(prepare_keywords(topic), key=lambda k: k.raw.lower())
    if not keywords:
        return F.lit("")
    if len(keywords) >= MANY:
        cleaned = [k.cleaned for k in keywords]
        spelled = F.map_from_arrays(_strings(cleaned), _strings([k.raw for k in keywords]))
        place = F.map_from_arrays(_strings(cleaned), F.sequence(F.lit(0), F.lit(len(cleaned) - 1)))
        mine = F.filter(hits, lambda h: _among(h, cleaned))
        ordered = F.sort_array(F.transform(mine, lambda h: F.struct(F.element_at(place, h).alias("i"), F.element_at(spelled, h).alias("k"))))
        return F.concat_ws("; ", F.transform(ordered, lambda e: e["k"]))
    found = [F.when(F.array_contains(hits, F.lit(k.cleaned)), F.lit(k.raw)) for k in keywords]
    return F.concat_ws("; ", *found)
