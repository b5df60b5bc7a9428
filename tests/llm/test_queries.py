"""The registered queries on the smallest tables: against SQL, or against plain programs."""

from __future__ import annotations

import hashlib
import zlib

import public_tokenizers
import pytest
from oracle_check import compare, connect
from tokenizers import Tokenizer

from moodtide.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


@pytest.fixture(scope="module")
def token_ids(documents):
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {k: tool.encode(t, add_special_tokens=False).ids for k, t in documents.items()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_bpe(spark, sf_dir, documents, token_ids):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = {k: (len(i), sha(",".join(map(str, i))), sha(documents[k])) for k, i in token_ids.items()}
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op2_bpe"](spark, sf_dir).collect()}
    assert found == expected


def test_token_files(spark, sf_dir, token_ids):
    expected, at = {}, 0
    for key in sorted(token_ids):
        ids = [*token_ids[key], 2]
        expected[key] = (at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        at += len(ids)
    rows = QUERIES["op10_token_files"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == expected


def test_secrets_match_plain_patterns(spark, sf_dir, documents):
    import re

    patterns = {
        "assign": (re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
        "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16), "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
    }
    for row in QUERIES["op5_secrets"](spark, sf_dir).collect():
        text, spans = documents[row["doc_id"]], []
        for at, (kind, (pattern, group, least)) in enumerate(patterns.items()):
            found = [m for m in pattern.finditer(text) if len(m[group]) >= least]
            assert row[f"n_{kind}"] == len(found)
            spans += [(m.start(), at, f"{kind}:{m.start()}:{m.end()}") for m in found]
        joined = ",".join(s for *_, s in sorted(spans))
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_language_is_right_on_held_out_documents(spark, sf_dir):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op8_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_toxicity_ranks_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"  # enough labels to learn from
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r["toxic"] is not None}
    rows = QUERIES["op9_toxicity"](spark, sf_dir).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    clean = [r for r in rows if truth.get(r["doc_id"]) == 0]
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    pairs = [(a, b) for a, y in held for b, z in held if y == 1 and z == 0]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) >= 0.8 * len(pairs)
