"""Text normalisation as column expressions.

Whitespace here means every character a Unicode-aware engine strips, not only the ASCII ones.
All of it is mapped to a plain blank by one ``translate`` before any pattern runs: the patterns
then need only small ASCII character classes, which cost a fraction of the Unicode ones, and the
result is the same because every later step treats all whitespace alike.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace characters, placeholder words, and the literals a CSV reader takes as missing.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
TEXT_PLACEHOLDERS = ("[deleted]", "[removed]", "nan", "none", "null")
AUTHOR_PLACEHOLDERS = ("[deleted]", "[removed]", "automoderator", "nan", "none")
NA_LITERALS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_URL = "http[^ ]+"
_MENTION = r"@[\p{L}\p{N}_]+"
_NOT_LETTER = "[^a-z ]+"
_BLANKS = "  +"


def blank_whitespace(c: Column) -> Column:
    """Every whitespace character as one plain blank."""
    return F.translate(c, WHITESPACE, " " * len(WHITESPACE))


def strip_whitespace(c: Column) -> Column:
    """Trim all whitespace kinds; a character-set trim, no pattern matching."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse_whitespace(c: Column) -> Column:
    """Trim, and reduce inner whitespace runs to one blank."""
    return F.trim(F.regexp_replace(blank_whitespace(c), _BLANKS, " "))


def clean_text(c: Column) -> Column:
    """Lower-case letters and single blanks only; links and @mentions removed whole.

    Order matters: links go first, so a mention glued to a link is judged on what is left.
    Each step uses the one before exactly once, so nothing is evaluated twice.
    """
    text = blank_whitespace(F.lower(c))
    for pattern in (_URL, _MENTION, _NOT_LETTER):
        text = F.regexp_replace(text, pattern, "")
    return F.trim(F.regexp_replace(text, _BLANKS, " "))


def clean_keyword(keyword: str) -> str:
    """``clean_text`` for one configured keyword, on the driver while a plan is being built."""
    text = keyword.lower().translate({ord(ch): " " for ch in WHITESPACE})
    for pattern, replacement in ((_URL, ""), (r"@\w+", ""), (_NOT_LETTER, ""), (_BLANKS, " ")):
        text = re.sub(pattern, replacement, text)
    return text.strip(" ")


def normalize_text(c: Column) -> Column:
    """Missing as the empty string, outer whitespace trimmed."""
    return F.coalesce(strip_whitespace(c.cast("string")), F.lit(""))


def normalize_key(c: Column) -> Column:
    """Lower-cased ``normalize_text``: group names and sentiment labels."""
    return F.lower(normalize_text(c))


def normalize_text_placeholders(c: Column) -> Column:
    """Collapsed text, with the deleted / removed / missing markers as the empty string."""
    text = F.coalesce(collapse_whitespace(c.cast("string")), F.lit(""))
    return F.when(F.lower(text).isin(*TEXT_PLACEHOLDERS), F.lit("")).otherwise(text)


def normalize_author(c: Column) -> Column:
    """Lower-cased author, with unusable accounts as the empty string."""
    author = normalize_key(c)
    return F.when(author.isin(*AUTHOR_PLACEHOLDERS), F.lit("")).otherwise(author)


def null_literals(c: Column, literals: tuple[str, ...] = NA_LITERALS) -> Column:
    """The literals a CSV reader takes for a missing value, as NULL."""
    return F.when(~c.isin(*literals), c)
