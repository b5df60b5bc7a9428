"""Scans texts for secrets.

An Aho-Corasick automaton finds all keywords of all patterns in one pass over a text; a pattern is then
tried at its keyword hits only, anchored there. Hexadecimal runs have no keyword; they are found by
looking at every 32nd character, of which any run of 32 covers one. Tokens that embed a checksum are
kept only if it is right.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import map_batches, slices, texts_of, with_columns

#: The base kinds, their patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX_RUN = re.compile(r"[0-9a-f]+")
_HEX = re.compile(r"[0-9a-f]")
#: Tokens of 30 random characters and a 6-character base-62 CRC-32 of them.
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("checked_token", "private_key")

#: Lower-case keywords and the kind whose pattern begins there.
_KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
    "api_key": "assign", "akia": "access", "ghp_": "checked_token", "gho_": "checked_token", "ghu_": "checked_token",
    "ghs_": "checked_token", "ghr_": "checked_token", "npm_": "checked_token", "-----begin ": "private_key",
}
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_automaton = ahocorasick.Automaton()
for _word, _kind in _KEYWORDS.items():
    _automaton.add_word(_word, (_kind, len(_word)))
_automaton.make_automaton()


def checksum62(body: str) -> str:
    """The six base-62 digits of a token body's CRC-32."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = _BASE62[digit] + digits
    return digits


def _same_length_lower(text: str) -> str:
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else "".join(c.lower() if c < "\x80" else c for c in text)


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    """Maximal hexadecimal runs of the least length."""
    end = 0
    for hit in _HEX.finditer(text[HEX_LEAST - 1 :: HEX_LEAST]):
        at = HEX_LEAST - 1 + hit.start() * HEX_LEAST
        if at < end:
            continue
        start, stop = at, _HEX_RUN.match(text, at).end()
        if stop - start < HEX_LEAST:  # else the run is long enough as it is
            low = max(end, stop - HEX_LEAST)
            if start > low and not _HEX_RUN.fullmatch(text, low, start):
                end = stop
                continue
        while start > end and text[start - 1] in "0123456789abcdef":
            start -= 1
        end = stop
        if stop - start >= HEX_LEAST:
            yield start, stop


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each secret, in code points, by start and then kind."""
    spans = [("hex", *run) for run in _hex_runs(text)]
    free = dict.fromkeys(KINDS, 0)
    hits = sorted((end - size + 1, kind) for end, (kind, size) in _automaton.iter(_same_length_lower(text)))
    for at, kind in hits:
        if at < free[kind]:
            continue
        if kind == "assign":
            found = ASSIGN.match(text, at)
            good = found and len(found[2]) >= ASSIGN_LEAST
        elif kind == "access":
            found = ACCESS.match(text, at)
            good = found and len(found[0]) >= ACCESS_LEAST
        elif kind == "checked_token":
            found = CHECKED.match(text, at)
            good = found and checksum62(found[1]) == found[2]
        else:
            good = found = PRIVATE_KEY.match(text, at)
        if found:
            free[kind] = found.end()
        if good:
            spans.append((kind, *found.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, secrets (array of kind, start, end; in code points, end exclusive).

    A pattern's matches are taken from the left and do not overlap within a kind; kinds may overlap.
    Null and empty texts have none. Very long texts are scanned whole, in one pass. Null ids and repeated
    rows give a row each; an empty table gives none. Other columns are ignored.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [[dict(zip(("kind", "start", "end"), s)) for s in find_secrets(t)] for t in texts_of(part.column(1))]
            yield with_columns(part, ["doc_id"], secrets=pa.array(found, pa.list_(span)))

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, scan, "doc_id bigint, secrets array<struct<kind string, start bigint, end bigint>>")


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
