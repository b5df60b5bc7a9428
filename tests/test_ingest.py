from __future__ import annotations

import dataclasses
import json
import random

import pytest
from pyspark.sql import functions as F

from moodtide.catalog import fixtures as fx
from moodtide.config import Study
from moodtide.operators import ingest, posts
from moodtide.operators.guards import MissingColumnsError, require_columns
from moodtide.plans.ingest_plan import cleaned_posts, load_posts, merged_posts, tagged_posts
from moodtide.sources import csv as csv_io
from moodtide.sources import text_lines, zst
from moodtide.streaming.ingest_stream import append_accepted, stream_accepted

STUDY = Study()
LINES = [
    ("", "blank"),
    (" 　", "blank"),
    ("bad{", "json_error"),
    ("[1]", "json_error"),
    ('{"id": "x"} tail', "json_error"),
    ('{"id": "x", "subreddit": "jobs", "created_utc": 1500000000}{"id": "y"}', "json_error"),
    ('{"a": 1},{"b": 2}', "json_error"),
    ('{"id": "n", "subreddit": null}', "missing_group"),
    ('{"id": "a", "created_utc": 1500000000}', "missing_group"),
    ('{"id": "b", "subreddit": "cats", "created_utc": 1500000000}', "not_target"),
    ('{"id": "c", "subreddit": "jobs", "created_utc": "abc"}', "out_of_range"),
    ('{"id": "d", "subreddit": "jobs", "created_utc": 1483228799}', "out_of_range"),
    ('{"id": "e", "subreddit": " CSMajors ", "created_utc": 1483228800, "title": null}', "kept"),
    ('{"id": "f", "subreddit": "jobs", "created_utc": "1.5e9", "body": " hi "}', "kept"),
    ('{"id": "g", "subreddit": "jobs", "created_utc": 1767225599, "id": "g2"}', "kept"),
    ('{"id": "h", "subreddit": "jobs", "created_utc": 1767225600}', "out_of_range"),
]


def line_frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_waterfall(spark):
    df = ingest.classify_lines(line_frame(spark, [line for line, _ in LINES]), STUDY)
    assert [r["reject_reason"] for r in df.collect()] == [reason for _, reason in LINES]


def test_counters_add_up(spark):
    df = ingest.classify_lines(line_frame(spark, [line for line, _ in LINES]), STUDY)
    row = ingest.ingest_counters(df).first().asDict()
    assert row == {
        "total_lines": 16, "parsed_records": 9, "json_errors": 5, "missing_group": 2, "out_of_range": 3,
        "kept_records": 3,
    }


def test_standard_columns(spark):
    rows = {r["id"]: r for r in ingest.keep_accepted(line_frame(spark, [line for line, _ in LINES]), STUDY).collect()}
    assert rows["e"]["source_type"] == "submission" and rows["e"]["title"] == "" and rows["e"]["subreddit"] == "csmajors"
    assert rows["f"]["source_type"] == "comment" and rows["f"]["body"] == "hi" and rows["f"]["created_utc"] == 1.5e9
    assert rows["g2"]["source_type"] == "unknown" and rows["g2"]["num_comments"] is None


def test_parse_happens_once(spark):
    kept = ingest.keep_accepted(line_frame(spark, ["{}"]), STUDY)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_dedup_keeps_first_and_survives_a_hot_key(spark):
    rows = [(None if i % 3 == 0 else f"id{i % 50}", float(1000 - i), f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, created_utc double, title string").repartition(7)
    first = {}
    for key, time, title in sorted(rows, key=lambda r: r[1]):
        first.setdefault(key, (time, title))
    got = {r["id"]: (r["created_utc"], r["title"]) for r in ingest.dedup_by_id(df).collect()}
    assert got == first


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1.0, "x")], "id string, created_utc double, title string")
    plan = ingest.dedup_by_id(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_dedup_uses_file_order(spark, tmp_path):
    for name, titles in (("b_filtered.csv", ["late"]), ("a_filtered.csv", ["first", "second"])):
        body = "".join(f",p1,jobs,,1.5e9,{t},,,,,\n" for t in titles)
        (tmp_path / name).write_text(",".join(ingest.STANDARD_COLUMNS) + "\n" + body)
    scanned = csv_io.scan_glob_union(spark, str(tmp_path))
    assert [tuple(r) for r in csv_io.rows_per_file(scanned).collect()] == [("a_filtered.csv", 2), ("b_filtered.csv", 1)]
    assert [r["title"] for r in ingest.dedup_by_id(scanned).collect()] == ["first"]


def test_missing_columns_are_named(spark):
    with pytest.raises(MissingColumnsError) as error:
        require_columns(spark.range(1), ("id", "title", "body"))
    assert error.value.missing == ["title", "body"]


def test_empty_input_keeps_its_schema(spark):
    merged = merged_posts(line_frame(spark, ["", "bad{"]), STUDY)
    tagged = tagged_posts(cleaned_posts(merged), STUDY)
    assert tagged.count() == 0 and "topic_ai_llm" in tagged.columns and "num_topics" in tagged.columns


def post_line(i, **more):
    return json.dumps({"id": str(i), "subreddit": "jobs", "author": f"u{i}", "created_utc": 1500000000 + i, "score": 1, **more})


def test_files_to_tagged_posts(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("\n".join([
        post_line(1, title="Got an offer", selftext="[removed]"),
        post_line(2, title="[deleted]", selftext=""),
        post_line(3, title="http://x.y", selftext="@me"),
        post_line(1, title="copy", selftext=""),
        post_line(4, body="null!!"),
        post_line(5, title="N/A", selftext="resume tips"),
    ]) + "\n")
    rows = {r["id"]: r for r in tagged_posts(load_posts(spark, str(tmp_path), STUDY), STUDY).collect()}
    assert set(rows) == {"1", "5"}
    assert rows["1"]["final_text"] == "Got an offer" and rows["1"]["topic_list"] == "recruiting_pipeline"
    assert rows["5"]["final_text"] == "resume tips" and rows["5"]["year_month"] == "2017-07"


def test_availability_and_accounting(spark):
    df = spark.createDataFrame(
        [("1", "s", "a", 1.0, t, b) for t, b in (("x", "y"), ("x", ""), ("[removed]", "y"), (None, "nan"))],
        "id string, subreddit string, author string, created_utc double, title string, body string",
    )
    selected = posts.select_fields(df)
    assert posts.title_body_availability(posts.normalize_post_fields(selected)).first()[:] == (1, 1, 1, 1)
    final = posts.with_final_text(selected)
    assert posts.drop_accounting(final, F.col("final_text") != "").first()[:] == (4, 1, 3)


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", 'quote " and, comma'), ("2", "line\nbreak\r\nand return"), ("3", " padded "), ("4", "back\\slash \\\" x"), ("5", None)]
    df = spark.createDataFrame(rows, "id string, body string")
    csv_io.write_csv(df, str(tmp_path / "out"))
    back = csv_io.scan_csv(spark, str(tmp_path / "out"), "id string, body string")
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_csv_null_literals_in_whole_columns(spark):
    missing = ["", "NA", "n/a", "None", "#N/A", "nan", "<NA>", "N/A", "NULL", "NaN", "null", "#NA", "-nan"]
    present = [" ", "na", "none", "NAN", "NA ", " n/a", "nan nan", "<na>", "a NA b", "None of them", "#N/A!", "text", "Null"]
    rows = [(i, t, t + "x") for i, t in enumerate(missing + present)] + [(99, None, None)]
    found = csv_io.csv_null_literals(spark.createDataFrame(rows, "id int, text string, other string")).collect()
    kept = {i: t if t in present else None for i, t, _ in rows}
    assert {r["id"]: r["text"] for r in found} == kept
    assert {r["id"]: r["other"] for r in found} == {i: t for i, _, t in rows}


def test_labeled_csv(spark, tmp_path):
    lines = ['"0","1","d","NO_QUERY","josé","bad ""day"""', '"4","2","d","q","u","good, very"', '"2","3","d","q","u","neutral"']
    (tmp_path / "l.csv").write_bytes("\n".join(lines).encode("latin-1"))
    scanned = csv_io.scan_labeled_csv(spark, str(tmp_path / "l.csv"))
    assert scanned.first()["user"] == "josé"
    labeled = posts.preprocess_labeled(posts.recode_label(scanned))
    assert [(r["label"], r["cleaned_text"]) for r in labeled.orderBy("id").collect()] == [(0, "bad day"), (1, "good very")]


def test_long_window_zst(spark, tmp_path):
    import zstandard

    rng = random.Random(1)
    want = []
    for n in range(2):
        lines = [f"{n}-{i} " + "".join(rng.choice("abcdef") for _ in range(50)) for i in range(500)]
        want += lines
        params = zstandard.ZstdCompressionParameters.from_level(1, window_log=28)
        packer = zstandard.ZstdCompressor(compression_params=params).compressobj()
        data = packer.compress(("\r\n" if n else "\n").join(lines).encode()) + packer.flush()
        (tmp_path / f"f{n}.zst").write_bytes(data)
    scanned = zst.scan_zst(spark, str(tmp_path))
    assert scanned.rdd.getNumPartitions() == 2
    rows = scanned.orderBy("src_file", "src_row").collect()
    assert [r["value"] for r in rows] == want


def test_packed_and_plain_dumps_give_the_same_posts(spark, tmp_path):
    """"First" in deduplication is file order in both readers; a folder may hold both kinds."""
    import zstandard

    records = [[post_line(i, title=f"{name} {i}") for i in range(40)] for name in ("first", "second")]
    for folder in ("plain", "packed", "mixed"):
        (tmp_path / folder).mkdir()
    for n, lines in enumerate(records):
        data = "\n".join(lines).encode()
        packer = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(1, window_log=28)).compressobj()
        packed = packer.compress(data) + packer.flush()
        (tmp_path / "plain" / f"{n}.jsonl").write_bytes(data)
        (tmp_path / "packed" / f"{n}.zst").write_bytes(packed)
        name, content = (f"{n}.zst", packed) if n else (f"{n}.jsonl", data)
        (tmp_path / "mixed" / name).write_bytes(content)
    found = [sorted(map(tuple, load_posts(spark, str(tmp_path / folder), STUDY).collect())) for folder in ("plain", "packed", "mixed")]
    assert len(found[0]) == 40 and found[0] == found[1] == found[2]
    assert all("first" in repr(row) for row in found[0])


def test_discovery_and_order(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.jsonl", "sub/b.ndjson", "sub/c.json", "skip.txt"):
        (tmp_path / name).write_text("one\n\n two \n")
    found = text_lines.discover_inputs(spark, str(tmp_path))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in found.collect()) == ["a.jsonl", "b.ndjson", "c.json"]
    lines = text_lines.scan_lines(spark, str(tmp_path), recursive=True)
    kept = text_lines.strip_and_skip_blank(lines).orderBy("src_file", "src_block", "src_row")
    assert [r["value"] for r in kept.collect()] == ["one", "two"] * 3


def test_stream_equals_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n in range(3):
        (source / f"{n}.jsonl").write_text("\n".join(post_line(n * 10 + i, title=f"t {i}") for i in range(5)) + "\nbad{\n")
    query = append_accepted(stream_accepted(spark, str(source), STUDY, 1), out, str(tmp_path / "cp"))
    query.awaitTermination(120)
    batch = ingest.keep_accepted(text_lines.scan_lines(spark, str(source)), STUDY).drop(*ingest.FILE_ORDER)
    streamed = spark.read.parquet(out)
    assert streamed.count() == 15 and streamed.exceptAll(batch).count() == 0


def test_target_table_is_the_target_list(spark, sf_dir):
    """A table of 100,000 names keeps what a list of them keeps, without a literal list in the plan."""
    posts = fx.dirty_posts(spark, sf_dir)
    names = spark.range(100_000).selectExpr("if(id < 3, concat(' SRC', id, ' '), concat('group', id)) AS name")
    nulls = spark.createDataFrame([(None,), ("",), (" src1 ",)], "name string")
    kept = ingest.filter_target_table(posts, names.unionByName(nulls), "name")
    assert kept.columns == posts.columns
    expected = ingest.filter_target_groups(posts, ("src0", "src1", "src2"))
    assert sorted(map(str, kept.collect())) == sorted(map(str, expected.collect())) and expected.count() > 0
    text = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in text and "INSET" not in text and "group99" not in text
    lines = fx.post_lines(spark, sf_dir)
    study = dataclasses.replace(fx.STUDY, groups=("src0", "src1", "src2"))
    found = ingest.classify_lines(lines, study, names, "name").groupBy("reject_reason").count().collect()
    assert sorted(map(str, found)) == sorted(map(str, ingest.classify_lines(lines, study).groupBy("reject_reason").count().collect()))
