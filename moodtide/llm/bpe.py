"""Byte-pair encoding and decoding with a public vocabulary.

The distinct words of a batch of texts form a trie, visited depth first. The state of a node is the last
token of the encoding of the path to it: the one token that ends there and stands validly after the last
token of the path without it. A node's state depends on its ancestors' states only, so the encoding of a
prefix that many words share is computed once, and a word's tokens are read off backwards from its node.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import map_batches, release_memory, slices, texts_of, worker_table

#: Fixed value: how byte-level vocabularies of this kind split text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words whose encodings a task remembers; when there are more, it starts afresh.
REMEMBERED = 250_000
_NEVER = 1 << 40
#: Texts, and bytes of them, whose words form one trie; a longer text has one by itself.
_TEXTS, _TRIE_BYTES = 512, 1 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the
    other bytes in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = byte_letters()
        model = content["model"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.ids = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        #: everything a token begins with
        self.beginnings = {t[:n] for t in self.ids for n in range(len(t) + 1)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        encoded = [[bytes(letters[c] for c in part) for part in pair] for pair in pairs]
        #: (left token, right token) -> rank of their merge
        self.merges = {(self.ids[a], self.ids[b]): rank for rank, (a, b) in enumerate(encoded)}
        #: token -> (left, right, rank) of the first merge that makes it
        self.made_of: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(encoded):
            self.made_of.setdefault(self.ids[a + b], (self.ids[a], self.ids[b], rank))
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.bytes_of = [b""] * size
        for token, i in self.ids.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces that stand at one end of a token while it is merged (side 0: left end, 1: right), from
        the whole token down to a byte, each with the rank of the merge that ends it."""
        found, until = [(token, _NEVER)], _NEVER
        while token in self.made_of:
            *parts, until = self.made_of[token]
            token = parts[side]
            found.append((token, until))
        return found


class TrieEncoder:
    """Encodes words with one vocabulary; remembers words, valid pairs, and which tokens can end where."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.vocabulary, self.remembered = vocabulary, remembered
        self.special = {s: array("i", [i]).tobytes() for s, i in vocabulary.special.items()}
        self.words: dict[str, bytes] = dict(self.special)
        self._older: dict[str, bytes] = {}
        self.lengths = list(map(len, vocabulary.bytes_of))
        self._pairs: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._edges: tuple[dict, dict] = ({}, {})
        # A tail is the longest end of a path that a token begins with; it is all that a longer path's tail
        # and the tokens that end there depend on.
        self._tails: list[bytes] = [b""]
        self._tail_numbers: dict[bytes, int] = {b"": 0}
        self._next_tail: dict[int, int] = {}
        self._ending: list[list[tuple[int, int]]] = [[]]
        specials = sorted(vocabulary.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self._split = regex.compile(PATTERN).findall

    def _step(self, tail: int, byte: int) -> int:
        """The tail of a path with this tail when a byte is added."""
        longer = self._tails[tail] + bytes((byte,))
        while longer not in self.vocabulary.beginnings:
            longer = longer[1:]
        number = self._tail_numbers.get(longer)
        if number is None:
            number = self._tail_numbers[longer] = len(self._tails)
            self._tails.append(longer)
            found = ((self.vocabulary.ids.get(longer[i:]), len(longer) - i) for i in range(len(longer)))
            self._ending.append([(t, n) for t, n in found if t is not None and self._is_whole(t)])
        self._next_tail[tail << 8 | byte] = number
        return number

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        known = self._edges[side]
        if token not in known:
            known[token] = self.vocabulary.edge(token, side)
        return known[token]

    def _crosses(self, left: int, right: int, least: int = _NEVER) -> bool:
        """Whether merging the bytes of both tokens would join pieces across their border before rank
        ``least``. Among equal ranks the leftmost pair is merged first."""
        merges = self.vocabulary.merges
        for a, a_until in self._edge(left, 1):
            for b, b_until in self._edge(right, 0):
                rank = merges.get((a, b))
                if rank is not None and rank < least and rank < a_until and rank <= b_until:
                    return True
        return False

    def _is_whole(self, token: int) -> bool:
        """Whether the bytes of a token are encoded as that token."""
        if token not in self._whole:
            parts = self.vocabulary.made_of.get(token)
            self._whole[token] = parts is None or (
                self._is_whole(parts[0]) and self._is_whole(parts[1]) and not self._crosses(*parts)
            )
        return self._whole[token]

    def learn(self, words: Iterable[str]) -> None:
        """Encode words: their trie, depth first. Sorted words are that order; ``last`` is the stack of states
        on the current path, and what a word shares with the one before it is not computed again."""
        lengths, pairs, ending, step, known = self.lengths, self._pairs, self._ending, self._next_tail, self.words
        if len(pairs) > 4 * self.remembered:
            pairs.clear()
        last, tails = [-1], [0]
        ordered = sorted([(w.encode(), w) for w in words])
        for (word, text), shared in zip(ordered, shared_lengths([w for w, _ in ordered])):
            del last[shared + 1 :], tails[shared + 1 :]
            tail = tails[-1]
            for end in range(shared, len(word)):
                key = tail << 8 | word[end]
                try:
                    tail = step[key]
                except KeyError:
                    tail = self._step(tail, word[end])
                tails.append(tail)
                for token, size in ending[tail]:  # the longest first
                    if size > end:
                        break
                    key = last[end + 1 - size] << 20 | token
                    valid = pairs.get(key)
                    if valid is None:
                        valid = pairs[key] = not self._crosses(last[end + 1 - size], token)
                    if valid:
                        break
                last.append(token)
            at, tokens = len(word), []
            while at:
                token = last[at]
                tokens.append(token)
                at -= lengths[token]
            tokens.reverse()
            known[text] = array("i", tokens).tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as 32-bit integers; special tokens written in a text become their ids."""
        split, special = self._split, self._special
        words = []
        for text in texts:
            if any(s in text for s in self.special):
                words.append([w for i, part in enumerate(special.split(text)) for w in ([part] if i % 2 else split(part))])
            else:
                words.append(split(text))
        if len(self.words) > self.remembered // 2:  # frequent words come back from the older half
            self.words, self._older = dict(self.special), self.words
        wanted, older = set().union(*words).difference(self.words), self._older
        if older:
            again = wanted.intersection(older)
            self.words.update((w, older[w]) for w in again)
            wanted -= again
        self.learn(wanted)
        known = self.words
        return [b"".join(map(known.__getitem__, ws)) for ws in words]


_HEAD = 32


def shared_lengths(words: list[bytes]) -> list[int]:
    """How many bytes each sorted word shares with the one before it."""
    if not words:
        return []
    heads = np.array([w[:_HEAD] for w in words], f"S{_HEAD}").view(np.uint8).reshape(-1, _HEAD)
    equal = np.hstack([heads[1:] == heads[:-1], np.zeros((len(words) - 1, 1), bool)])
    lengths = np.array(list(map(len, words)))
    shared = np.minimum(equal.argmin(axis=1), np.minimum(lengths[1:], lengths[:-1]))
    for i in np.flatnonzero(shared == _HEAD):
        at, a, b = _HEAD, words[i], words[i + 1]
        while at < len(a) and at < len(b) and a[at] == b[at]:
            at += 1
        shared[i] = at
    return [0, *shared.tolist()]


@worker_table
@lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    """The encoder of a vocabulary file; a Python worker makes it once."""
    made = TrieEncoder(Vocabulary(path))
    release_memory()  # the parsed file
    return made


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``ids`` (array<int>), the token ids of each whole text; nothing is shuffled.

    Null and empty texts have no ids. Very long texts and words are encoded whole, in time proportional to
    their length. Null or repeated keys give a row each; an empty table gives none. Other columns are
    ignored, and a kept column named ``ids`` is replaced.
    """
    return _encoded(docs, vocabulary, text, keep, False)


def encode_and_check(docs: DataFrame, vocabulary: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``encode``, and ``decoded_sha256``: lowercase SHA-256 of the text that the ids decode to, as ``decode``
    has it, in UTF-8. Encoding, decoding and digest are one pass over a batch, in one Python worker."""
    return _encoded(docs, vocabulary, text, keep, True)


def _encoded(docs: DataFrame, vocabulary: str | None, text: str, keep: tuple[str, ...], check: bool) -> DataFrame:
    path = vocabulary or default_vocabulary()
    added = ["ids", "decoded_sha256"][: 1 + check]
    keep = tuple(k for k in keep if k not in added)

    def digests(flat: pa.Array, sizes: list[int]) -> pa.Array:
        texts = (data.decode("utf-8", "replace").encode() for data in _joined_tokens(_encoder_bytes(path), flat, np.array(sizes)))
        return pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for part in _trie_parts(batch):
                found = tool.encode_batch(texts_of(part.column(0)))
                sizes = [len(x) // 4 for x in found]
                offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(found), np.int32))
                columns = [pa.ListArray.from_arrays(pa.array(offsets), flat)] + ([digests(flat, sizes)] if check else [])
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names=[*keep, *added])
            release_memory()  # two such workers share an executor with a grown JVM

    rows = docs.select(F.col(text).cast("string").alias("_text"), *keep)
    types = ["ids array<int>", "decoded_sha256 string"][: 1 + check]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]), *types])
    return map_batches(rows, run, schema)


def _trie_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut into the texts of one trie each. Every word of a piece is a Python string while it is encoded,
    many times the size of its text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        within = int(np.searchsorted(ends, ends[start] - sizes[start] + _TRIE_BYTES, "right"))
        stop = min(max(start + 1, within), start + _TEXTS)
        yield batch.slice(start, stop - start)
        start = stop


@worker_table
@lru_cache(maxsize=2)
def _encoder_bytes(path: str) -> pa.Array:
    """The bytes of each token, from the encoder at hand, so that the file is not parsed a second time."""
    return pa.array(encoder(path).vocabulary.bytes_of, pa.large_binary())


@worker_table
@lru_cache(maxsize=2)
def _token_bytes(path: str) -> pa.Array:
    """The bytes of each token, read from the file without its merges; a Python worker reads them once."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters, special = byte_letters(), {t["content"]: t["id"] for t in content["added_tokens"]}
    found = {i: bytes(letters[c] for c in t) for t, i in content["model"]["vocab"].items() if t not in special}
    found |= {i: t.encode() for t, i in special.items()}
    return pa.array([found.get(i, b"") for i in range(1 + max(found))], pa.large_binary())


def _joined_tokens(table: pa.Array, ids: pa.Array, sizes: np.ndarray) -> Iterator[bytes]:
    """The bytes of each list of ids, given as all lists' ids and the lists' sizes."""
    joined = table.take(ids)
    _, offsets, values = joined.buffers()
    ends = np.frombuffer(offsets, np.int64, len(joined) + 1, 8 * joined.offset)
    data = values.to_pybytes() if values is not None else b""
    cuts = ends[np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))]
    return (data[a:b] for a, b in zip(cuts, cuts[1:]))


def decode(encoded: DataFrame, vocabulary: str | None = None, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``decoded`` (string), the text of each list of ids, special tokens included.

    The tokens' bytes are joined and read as UTF-8; invalid sequences become U+FFFD. Null and empty lists
    give empty text; ids outside the vocabulary are an error. An empty table gives no rows. Other columns
    are ignored, and a kept column named ``decoded`` is replaced.
    """
    path = vocabulary or default_vocabulary()
    keep = tuple(k for k in keep if k != "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(path)
        for part in slices(batches):
            lists = part.column(0)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = [data.decode("utf-8", "replace") for data in _joined_tokens(table, lists.flatten(), sizes)]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string())], names=[*keep, "decoded"])

    rows = encoded.select(F.col(ids).cast("array<int>").alias("_ids"), *keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]), "decoded string"])
    return map_batches(rows, run, schema)
