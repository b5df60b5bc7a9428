"""The stages of the pipeline, each against what it should keep."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from moodtide.llm import exact_dedup, mixing, near_dedup
from moodtide.session import durable

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, held = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, held = held, durable(stage(spark, held, SF))
        assert held.columns == columns
        kept[name] = (before, held)

    def ids(df):
        return Counter(r["doc_id"] for r in df.select("doc_id").collect())

    before, after = kept["exact_dedup"]
    assert ids(after) == ids(exact_dedup.exact_dedup(before).filter("kept"))
    before, after = kept["near_dedup"]
    assert ids(after) == ids(near_dedup.near_duplicates(before).filter("kept"))
    before, after = kept["mixing"]
    expected = Counter({r["doc_id"]: r["times"] for r in mixing.mix(before).collect()})
    assert ids(after) == +expected
    last = corpus_pipeline.STAGES[-1][1](spark, held, SF)
    assert ids(last) == ids(held)


def test_run(spark):
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and result.count() > 0
