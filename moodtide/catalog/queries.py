"""Every registered query: the Spark callable and, next to it, the SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.catalog import fixtures as fx
from moodtide.catalog import oracles as o
from moodtide.catalog.fixtures import STUDY, rounded
from moodtide.config import matched_column, topic_column
from moodtide.functions import dates, numeric, text
from moodtide.functions.topics import contains_phrase, prepare_keywords
from moodtide.operators import cube_store, features, guards, hypotheses, id_table, ingest, models, sentiment, tagging, trends, users
from moodtide.operators import posts as post_ops
from moodtide.operators.measures import measured, total, valid
from moodtide.plans.report_plan import POST_COLUMNS
from moodtide.plans.training_plan import fit_both
from moodtide.session import durable, numbered
from moodtide.sources import artifacts, csv_ranges, text_lines, zst, zst_frames
from moodtide.sources import csv as csv_io

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def md5(c: str, name: str | None = None):
    return F.md5(F.col(c)).alias(name or f"{c}_md5")


def _standard_out() -> list:
    kept = ["source_type", "id", "subreddit", "author", "created_utc", "score", "num_comments", "permalink", "url"]
    return [*kept, md5("title"), md5("body")]


# --- sources and sinks ------------------------------------------------------------------------------

_ID_GROUP_TIME = "SELECT id, subreddit, author, created_utc::DOUBLE AS created_utc, md5(title) AS title_md5, md5(body) AS body_md5 FROM posts"


def _written_json(spark, sf) -> str:
    path = fx.fresh(spark, "json")
    fx.posts(spark, sf).drop("doc_id", "predicted_label").write.json(path)
    return path


def _from_lines(lines: DataFrame) -> DataFrame:
    parsed = ingest.parse_json_record(lines)
    r = F.col("record")
    return parsed.select(
        r["id"].alias("id"), r["subreddit"].alias("subreddit"), r["author"].alias("author"),
        numeric.coerce_double(r["created_utc"]).alias("created_utc"), F.md5(r["title"]).alias("title_md5"),
        F.md5(r["body"]).alias("body_md5"),
    )


@query("scan_jsonl", o.posts_sql(_ID_GROUP_TIME))
def scan_jsonl(spark, sf):
    lines = text_lines.scan_lines(spark, _written_json(spark, sf))
    return _from_lines(text_lines.strip_and_skip_blank(lines))


@query("scan_zst", o.posts_sql(_ID_GROUP_TIME))
def scan_zst(spark, sf):
    path = fx.fresh(spark, "zst")
    columns = ["id", "subreddit", "author", "created_utc", "title", "body"]
    lines = fx.posts(spark, sf).select(F.to_json(F.struct(*columns)).alias("value"))
    fx.write_zst_lines(lines, path)
    return _from_lines(zst.scan_zst(spark, path).select("value", *ingest.FILE_ORDER))


@query("scan_zst_frames", o.posts_sql(_ID_GROUP_TIME))
def scan_zst_frames(spark, sf):
    """Dumps of many frames, read in short runs so that lines cross from one task's frames to another's."""
    path = fx.fresh(spark, "zst")
    columns = ["id", "subreddit", "author", "created_utc", "title", "body"]
    lines = fx.posts(spark, sf).select(F.to_json(F.struct(*columns)).alias("value"))
    fx.write_zst_lines(lines, path, frame_bytes=300_000)
    return _from_lines(zst_frames.scan_zst_frames(spark, path, run_bytes=1 << 20).select("value", *ingest.FILE_ORDER))


@query(
    "scan_input_discovery",
    "SELECT DISTINCT source AS folder, 'json' AS suffix FROM documents WHERE source NOT LIKE '%1%' "
    "UNION ALL SELECT DISTINCT 'packed', 'zst' FROM documents WHERE source LIKE '%1%'",
)
def scan_input_discovery(spark, sf):
    """A tree of plain and compressed dumps with other files among them."""
    root = fx.fresh(spark, "tree")
    posts = fx.posts(spark, sf).withColumn("grp", F.col("subreddit")).drop("doc_id", "predicted_label")
    packed = F.col("grp").contains("1")
    posts.filter(~packed).write.partitionBy("grp").json(f"{root}/plain")
    fx.write_zst_lines(posts.filter(packed).select(F.to_json(F.struct("id", "title", "body")).alias("value")), f"{root}/grp=packed")
    posts.select("id", "grp").write.partitionBy("grp").csv(f"{root}/other")
    found = text_lines.discover_inputs(spark, root).filter(F.col("length") > 0)
    suffix = F.substring_index("path", ".", -1).alias("suffix")
    return found.select(F.regexp_extract("path", "grp=([^/]+)/", 1).alias("folder"), suffix).distinct()


@query(
    "scan_labeled_csv",
    f"""WITH x AS (SELECT doc_id, quality, {o.clean('text')} AS c FROM documents JOIN labels USING (doc_id)
    WHERE quality IS NOT NULL)
    SELECT CAST(doc_id AS VARCHAR) AS id, quality AS label, md5(c) AS text_md5, 'réné' AS "user" FROM x""",
)
def scan_labeled_csv(spark, sf):
    labels = fx.table(spark, sf, "labels").filter(F.col("quality").isNotNull())
    rows = fx.cleaned_docs(spark, sf).join(labels, "doc_id").select(
        (F.col("quality") * 4).alias("label"), F.col("id"), F.lit("Mon Apr 06").alias("date"),
        F.lit("NO_QUERY").alias("flag"), F.lit("réné").alias("user"), F.col("cleaned_text").alias("text"),
    )
    path = fx.fresh(spark, "labeled")
    rows.write.option("encoding", csv_io.LABELED_ENCODING).option("quoteAll", True).csv(path)
    scanned = post_ops.recode_label(csv_io.scan_labeled_csv(spark, path))
    return scanned.select("id", "label", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "user")


_POST_CSV = "id string, subreddit string, author string, created_utc double, title string, body string"


def _written_csv(spark, sf, partition: str | None = None) -> str:
    path = fx.fresh(spark, "csv")
    rows = fx.posts(spark, sf).select("id", "subreddit", "author", F.col("created_utc").cast("double"), "title", "body")
    csv_io.write_csv(rows, path)
    return path


def _csv_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "subreddit", "author", "created_utc", F.md5(F.coalesce("title", F.lit(""))).alias("title_md5"),
        F.md5(F.coalesce("body", F.lit(""))).alias("body_md5"),
    )


@query("scan_csv_with_header", o.posts_sql(_ID_GROUP_TIME))
def scan_csv_with_header(spark, sf):
    return _csv_rows(csv_io.scan_csv(spark, _written_csv(spark, sf), _POST_CSV))


@query("scan_glob_union", o.posts_sql(_ID_GROUP_TIME))
def scan_glob_union(spark, sf):
    return _csv_rows(csv_io.scan_glob_union(spark, _written_csv(spark, sf), _POST_CSV, "*.csv"))


@query("scan_csv_ranges", o.posts_sql(_ID_GROUP_TIME))
def scan_csv_ranges(spark, sf):
    """The same files read by byte ranges, short ones so that every file has several."""
    return _csv_rows(csv_ranges.scan_csv_ranges(spark, _written_csv(spark, sf), _POST_CSV, range_bytes=1 << 20))


@query(
    "sink_csv",
    o.posts_sql("SELECT subreddit, count(*) AS posts, sum(length(body))::BIGINT AS body_chars FROM posts GROUP BY subreddit"),
)
def sink_csv(spark, sf):
    back = csv_io.scan_csv(spark, _written_csv(spark, sf), _POST_CSV)
    return back.groupBy("subreddit").agg(
        F.count(F.lit(1)).alias("posts"), F.sum(F.coalesce(F.length("body"), F.lit(0))).alias("body_chars")
    )


@query(
    "sink_topic_definitions_json",
    o.tagged_sql(
        "SELECT topic_bucket, topic_description, CASE topic_bucket WHEN 'alpha' THEN 3 WHEN 'none' THEN 1 ELSE 2 END "
        "AS num_keywords, (SELECT count(*) FROM tl WHERE tl.topic_bucket = topics.topic_bucket) AS posts FROM topics"
    ),
)
def sink_topic_definitions_json(spark, sf):
    path = fx.fresh(spark, "topics")
    artifacts.write_topic_definitions(tagging.topic_definitions(spark, STUDY), path)
    stored = artifacts.read_topic_definitions(spark, path)
    counts = trends.topic_overall_frequency(fx.rows(spark, sf), STUDY).select("topic_bucket", "topic_post_count")
    return stored.join(F.broadcast(counts), "topic_bucket").select(
        "topic_bucket", "topic_description", F.size("keywords").alias("num_keywords"),
        F.col("topic_post_count").alias("posts"),
    )


_MODEL_ROWS = f"SELECT term, {o.r6('idf')} AS idf, {o.r6('coefficient')} AS coefficient FROM model"


def _split(spark, sf) -> DataFrame:
    """Cleaned labelled rows, written once, with their split."""
    rows = durable(fx.labeled_docs(spark, sf))
    return models.apply_split(rows, durable(models.split_thresholds(rows)))


def _train(spark, sf) -> DataFrame:
    return _split(spark, sf).filter(F.col("split") == "train").drop("split")


def _bayes(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vocabulary and Naive Bayes log probabilities."""
    vocabulary = durable(models.fit_vocabulary(train))
    vectors = features.document_vectors(train, vocabulary)
    return vocabulary, models.train_naive_bayes(vectors, vocabulary)


def _bayes_model(train: DataFrame) -> DataFrame:
    _, log_probs = _bayes(train)
    return models.naive_bayes_model(log_probs, models.class_log_prior(train))


def _stored_model(spark, sf) -> DataFrame:
    path = fx.fresh(spark, "model")
    artifacts.write_model(_bayes_model(_train(spark, sf)), path)
    return artifacts.read_model(spark, path)


@query(
    "sink_model_artifacts",
    o.model_sql(
        "SELECT count(*) AS rows, count(term) AS terms, round(sum(idf), 4) AS idf_sum, "
        "round(sum(coefficient), 4) AS coefficient_sum FROM model"
    ),
)
def sink_model_artifacts(spark, sf):
    return _stored_model(spark, sf).agg(
        F.count(F.lit(1)).alias("rows"), F.count("term").alias("terms"), F.round(F.sum("idf"), 4).alias("idf_sum"),
        F.round(F.sum("coefficient"), 4).alias("coefficient_sum"),
    )


@query("scan_model_artifacts", o.model_sql(_MODEL_ROWS))
def scan_model_artifacts(spark, sf):
    return rounded(_stored_model(spark, sf))


#: Cells of a text column: every spelling of a missing value, some that only look like one, else the whole text.
_CELLS = (*csv_io.NA_LITERALS, "na", "None ", " NA", "NULLS", "n/a n/a", "NAN")
_CELL_CASES = " ".join(f"WHEN {i} THEN {o.quote(cell)}" for i, cell in enumerate(_CELLS))


@query(
    "csv_null_literals",
    f"""WITH cells AS (SELECT doc_id, CASE doc_id % {2 * len(_CELLS)} {_CELL_CASES} ELSE text END AS piece, source FROM documents)
    SELECT doc_id, CASE WHEN piece NOT IN ({', '.join(map(o.quote, csv_io.NA_LITERALS))}) THEN piece END AS piece, source FROM cells""",
)
def csv_null_literals(spark, sf):
    """Whole texts, and cells with every spelling among them."""
    cells = F.expr(f"CASE doc_id % {2 * len(_CELLS)} {_CELL_CASES} ELSE text END")
    return csv_io.csv_null_literals(fx.table(spark, sf, "documents").select("doc_id", cells.alias("piece"), "source"))


@query(
    "require_columns",
    o.posts_sql("SELECT subreddit, count(*) AS posts, 'final_text' AS missing FROM posts GROUP BY subreddit"),
)
def require_columns(spark, sf):
    posts = fx.posts(spark, sf)
    try:
        guards.require_columns(posts, ("id", "final_text"))
        missing = ""
    except guards.MissingColumnsError as error:
        missing = ",".join(error.missing)
    checked = guards.require_columns(posts, post_ops.SELECTED_COLUMNS)
    return checked.groupBy("subreddit").agg(F.count(F.lit(1)).alias("posts")).withColumn("missing", F.lit(missing))


# --- ingest -----------------------------------------------------------------------------------------


def _classified(spark, sf) -> DataFrame:
    return ingest.classify_lines(fx.post_lines(spark, sf), STUDY)


def _kept(spark, sf) -> DataFrame:
    return ingest.keep_accepted(fx.post_lines(spark, sf), STUDY)


@query(
    "parse_json_record",
    o.lines_sql(
        "SELECT id, is_object, CASE WHEN is_object THEN len(keys) END AS num_keys, author, "
        "md5(title) AS title_md5, md5(body) AS body_md5, md5(selftext) AS selftext_md5 FROM fields"
    ),
)
def parse_json_record(spark, sf):
    parsed = ingest.parse_json_record(fx.post_lines(spark, sf))
    r = F.col("record")
    is_object = F.col("keys").isNotNull()
    return parsed.select(
        F.when(is_object, r["id"]).alias("id"), is_object.alias("is_object"),
        F.when(is_object, F.size("keys")).cast("bigint").alias("num_keys"),
        F.when(is_object, r["author"]).alias("author"), F.md5(F.when(is_object, r["title"])).alias("title_md5"),
        F.md5(F.when(is_object, r["body"])).alias("body_md5"),
        F.md5(F.when(is_object, r["selftext"])).alias("selftext_md5"),
    )


@query("detect_source_type", o.lines_sql("SELECT id, source_type FROM typed WHERE is_object"))
def detect_source_type(spark, sf):
    parsed = ingest.parse_json_record(fx.post_lines(spark, sf)).filter(F.col("keys").isNotNull())
    return parsed.select(F.col("record.id").alias("id"), ingest.detect_source_type(F.col("keys")).alias("source_type"))


@query(
    "standardize_record",
    o.lines_sql(f"SELECT {o.STANDARD_OUT} FROM (SELECT {o.STANDARD} FROM typed WHERE is_object) s"),
)
def standardize_record(spark, sf):
    return ingest.standardize_record(ingest.parse_json_record(fx.post_lines(spark, sf))).select(*_standard_out())


_GROUPS = ", ".join(o.quote(g) for g in STUDY.groups)


@query(
    "filter_target_groups",
    o.dirty_sql(f"SELECT id, subreddit, author FROM dirty WHERE {o.norm_key('subreddit')} IN ({_GROUPS})"),
)
def filter_target_groups(spark, sf):
    return ingest.filter_target_groups(fx.dirty_posts(spark, sf), STUDY.groups).select("id", "subreddit", "author")


@query(
    "filter_target_group_table",
    o.dirty_sql(
        f"SELECT id, subreddit, author FROM dirty WHERE {o.norm_key('subreddit')} IN "
        "(SELECT lower(source) FROM documents WHERE doc_id % 3 = 0)"
    ),
)
def filter_target_group_table(spark, sf):
    """The list of groups is a table: the sources of every third document, padded and in capitals, many times each."""
    named = fx.table(spark, sf, "documents").filter(F.col("doc_id") % 3 == 0)
    targets = named.select(F.concat(F.lit("  "), F.upper("source"), F.lit(" ")).alias("name"))
    return ingest.filter_target_table(fx.dirty_posts(spark, sf), targets, "name").select("id", "subreddit", "author")


@query(
    "filter_year_range",
    o.posts_sql("SELECT id, created_utc FROM posts WHERE year(make_timestamp(created_utc * 1000000)) BETWEEN 1996 AND 2000"),
)
def filter_year_range(spark, sf):
    return ingest.filter_year_range(fx.posts(spark, sf), STUDY.year_min, STUDY.year_max).select("id", "created_utc")


@query("reject_reason_waterfall", o.lines_sql("SELECT CASE WHEN is_object THEN id END AS id, reject_reason FROM verdict"))
def reject_reason_waterfall(spark, sf):
    is_object = F.col("keys").isNotNull()
    return _classified(spark, sf).select(F.when(is_object, F.col("record.id")).alias("id"), "reject_reason")


@query(
    "ingest_counters",
    o.lines_sql(
        "SELECT count(*) AS total_lines, count(*) FILTER (reject_reason NOT IN ('blank', 'json_error')) AS parsed_records, "
        + ", ".join(
            f"count(*) FILTER (reject_reason = '{reason}') AS {name}"
            for reason, name in (
                ("json_error", "json_errors"), ("missing_group", "missing_group"),
                ("out_of_range", "out_of_range"), ("kept", "kept_records"),
            )
        )
        + " FROM verdict"
    ),
)
def ingest_counters(spark, sf):
    return ingest.ingest_counters(_classified(spark, sf))


@query("kept_by_group", o.lines_sql("SELECT grp AS subreddit, count(*) AS records FROM kept GROUP BY grp"))
def kept_by_group(spark, sf):
    return ingest.kept_by_group(_kept(spark, sf))


@query("kept_by_source_type", o.lines_sql("SELECT source_type, count(*) AS records FROM kept GROUP BY source_type"))
def kept_by_source_type(spark, sf):
    return ingest.kept_by_source_type(_kept(spark, sf))


def _copies(spark, sf) -> DataFrame:
    """All posts, every tenth once more with a later time, a third of them without an id."""
    posts = fx.posts(spark, sf)
    keyed = posts.withColumn("id", F.when(F.col("doc_id") % 3 != 0, F.col("id")))
    later = keyed.withColumn("created_utc", F.col("created_utc") + 86400)
    again = later.filter(F.col("doc_id") % 10 == 0)
    return ingest.union_files([keyed, again])


_COPIES = f"""keyed AS (SELECT * REPLACE (CASE WHEN doc_id % 3 <> 0 THEN id END AS id) FROM posts),
copies AS (SELECT * FROM keyed UNION ALL SELECT * REPLACE (created_utc + 86400 AS created_utc) FROM keyed
  WHERE doc_id % 10 = 0)"""


@query("union_files", f"WITH {o.POSTS}, {_COPIES} SELECT id, subreddit, created_utc FROM copies")
def union_files(spark, sf):
    return _copies(spark, sf).select("id", "subreddit", "created_utc")


_FIRST_COPIES = f"""WITH {o.POSTS}, {_COPIES}, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_utc, doc_id) AS k
    FROM copies) SELECT id, doc_id, subreddit, author, created_utc, md5(title) AS title_md5 FROM r WHERE k = 1"""


@query("dedup_by_id", _FIRST_COPIES)
def dedup_by_id(spark, sf):
    unique = ingest.dedup_by_id(_copies(spark, sf), order_by=("created_utc", "doc_id"))
    return unique.select("id", "doc_id", "subreddit", "author", "created_utc", md5("title"))


@query("dedup_new_posts", _FIRST_COPIES)
def dedup_new_posts(spark, sf):
    """The same posts as two dumps, the later one deduplicated against the ids of the earlier."""
    copies = durable(_copies(spark, sf))
    later = F.coalesce(F.col("created_utc") >= copies.agg(F.avg("created_utc")).scalar(), F.lit(False))
    table, order = id_table.IdTable(spark, buckets=8), ("created_utc", "doc_id")
    dumps = [
        id_table.dedup_new_posts(dump, table, name, order)
        for name, dump in (("earlier", copies.filter(~later)), ("later", copies.filter(later)))
    ]
    return dumps[0].unionByName(dumps[1]).select("id", "doc_id", "subreddit", "author", "created_utc", md5("title"))


@query("distinct_groups_present", o.posts_sql("SELECT DISTINCT subreddit FROM posts"))
def distinct_groups_present(spark, sf):
    return ingest.distinct_groups_present(fx.posts(spark, sf))


@query(
    "sort_by_time",
    o.posts_sql(
        "SELECT row_number() OVER (ORDER BY created_utc, id) - 1 AS place, id, created_utc, md5(title) AS title_md5, "
        "md5(body) AS body_md5 FROM posts"
    ),
)
def sort_by_time(spark, sf):
    """Whole posts are sorted; the place of each in the result is compared."""
    placed = numbered(ingest.sort_by_time(fx.posts(spark, sf)), "place")
    return placed.select("place", "id", "created_utc", md5("title"), md5("body"))


# --- projections, filters and accounting --------------------------------------------------------------


@query(
    "select_fields",
    o.dirty_sql("SELECT id, subreddit, author, created_utc, md5(title) AS title_md5, md5(body) AS body_md5 FROM selected"),
)
def select_fields(spark, sf):
    return post_ops.select_fields(fx.dirty_posts(spark, sf)).select(
        "id", "subreddit", "author", "created_utc", md5("title"), md5("body")
    )


@query(
    "project_required_columns",
    o.tagged_sql("SELECT id, subreddit, year_month, time_period, predicted_label FROM t"),
)
def project_required_columns(spark, sf):
    return guards.project_columns(
        fx.tagged(spark, sf), ("id", "subreddit", "year_month", "time_period", "predicted_label")
    )


_LAST_STEP = r"/([^/?#]*)(?:[?#].*)?$"


@query(
    "coerce_created_utc",
    f"SELECT page_id, TRY_CAST(regexp_extract(url, '{_LAST_STEP}', 1) AS DOUBLE) AS created_utc FROM pages",
)
def coerce_created_utc(spark, sf):
    """The last step of each URL: a number, a number with a suffix, or nothing."""
    raw = fx.table(spark, sf, "pages").select("page_id", F.regexp_extract("url", _LAST_STEP, 1).alias("created_utc"))
    return raw.select("page_id", numeric.coerce_double(F.col("created_utc")).alias("created_utc"))


@query(
    "coerce_flags",
    "SELECT event_id, CAST(coalesce(trunc(CASE WHEN event_id % 2 = 0 THEN value / 100 ELSE TRY_CAST(event_type AS DOUBLE) END), 0) "
    "AS INTEGER) AS flag, 0 AS absent_flag FROM events",
)
def coerce_flags(spark, sf):
    """Amounts and words of events, as strings."""
    amount = (F.col("value") / 100).cast("string")
    word = F.when(F.col("event_id") % 2 == 0, amount).otherwise(F.col("event_type"))
    raw = fx.table(spark, sf, "events").select("event_id", word.alias("flag"))
    return raw.select(
        "event_id", numeric.numeric_column(raw, "flag", numeric.coerce_flag).alias("flag"),
        numeric.numeric_column(raw, "no_such_flag", numeric.coerce_flag).alias("absent_flag"),
    )


@query(
    "optional_probability_columns",
    o.tagged_sql(f"SELECT subreddit, {o.r6('avg(prob_positive)')} AS avg_prob_positive, NULL::DOUBLE AS avg_prob_negative FROM t GROUP BY subreddit"),
)
def optional_probability_columns(spark, sf):
    posts = fx.tagged(spark, sf).drop("prob_negative")
    picked = posts.select(
        "subreddit", *[numeric.numeric_column(posts, c).alias(c) for c in ("prob_positive", "prob_negative")]
    )
    return rounded(
        picked.groupBy("subreddit").agg(*[F.avg(c).alias(f"avg_{c}") for c in ("prob_positive", "prob_negative")])
    )


@query(
    "build_final_text",
    o.dirty_sql("SELECT id, subreddit, author, md5(final_text) AS final_text_md5 FROM final WHERE final_text <> ''"),
)
def build_final_text(spark, sf):
    final = post_ops.build_final_text(post_ops.select_fields(fx.dirty_posts(spark, sf)))
    return final.select("id", "subreddit", "author", md5("final_text"))


@query("drop_empty_text", o.tagged_sql("SELECT id, length(c) AS chars FROM whole WHERE trim(c) <> ''"))
def drop_empty_text(spark, sf):
    kept = post_ops.keep_with_cleaned_text(fx.final_texts(spark, sf), "final_text")
    return kept.select("id", F.length("cleaned_text").cast("bigint").alias("chars"))


@query(
    "drop_missing_label",
    "SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 1 ELSE quality END AS label FROM labels "
    "WHERE quality IS NOT NULL AND doc_id % 5 <> 0",
)
def drop_missing_label(spark, sf):
    quality = F.col("quality") * 4
    raw = F.when(F.col("doc_id") % 5 == 0, F.lit(2)).when((F.col("doc_id") % 7 == 0) & quality.isNotNull(), F.lit(4))
    labels = fx.table(spark, sf, "labels").select("doc_id", raw.otherwise(quality).alias("label"))
    return post_ops.recode_label(labels)


@query("filter_valid_labels", o.tagged_sql("SELECT id, predicted_label AS label, prob_positive FROM v"))
def filter_valid_labels(spark, sf):
    posts = fx.tagged(spark, sf)
    label = numeric.numeric_column(posts, "predicted_label", numeric.coerce_label)
    return posts.select("id", label.alias("label"), "prob_positive").filter(F.col("label").isNotNull())


@query("filter_topic_members", o.tagged_sql("SELECT id, topic_alpha, topic_beta FROM t WHERE topic_alpha = 1 AND topic_beta = 0"))
def filter_topic_members(spark, sf):
    posts = fx.tagged(spark, sf, for_filter=True).select("id", "topic_alpha", "topic_beta")
    return posts.filter((F.col("topic_alpha") == 1) & (F.col("topic_beta") == 0))


@query(
    "filter_nonempty_period",
    o.tagged_sql("SELECT id, year_month, time_period FROM t WHERE doc_id % 4 <> 0"),
)
def filter_nonempty_period(spark, sf):
    blank = F.when(F.col("doc_id") % 4 == 0, F.lit(" "))
    posts = fx.tagged(spark, sf).withColumns(
        {c: F.coalesce(blank, F.col(c)) for c in ("year_month", "time_period")}
    )
    rows = posts.select("id", *[text.normalize_text(F.col(c)).alias(c) for c in ("year_month", "time_period")])
    return rows.filter((F.col("year_month") != "") & (F.col("time_period") != ""))


@query(
    "missing_value_profile",
    o.dirty_sql(
        "SELECT "
        + ", ".join(f"count(*) FILTER ({c} = '') AS missing_{c}" for c in post_ops.TEXT_COLUMNS)
        + ", count(*) FILTER (created_utc IS NULL) AS missing_created_utc FROM selected"
    ),
)
def missing_value_profile(spark, sf):
    return post_ops.missing_value_profile(post_ops.select_fields(fx.dirty_posts(spark, sf)))


@query(
    "title_body_availability",
    o.dirty_sql(
        "SELECT count(*) FILTER (title <> '' AND body <> '') AS both_present, count(*) FILTER (title <> '' AND body = '') "
        "AS title_only, count(*) FILTER (title = '' AND body <> '') AS body_only, "
        "count(*) FILTER (title = '' AND body = '') AS both_empty FROM normalized"
    ),
)
def title_body_availability(spark, sf):
    selected = post_ops.select_fields(fx.dirty_posts(spark, sf))
    return post_ops.title_body_availability(post_ops.normalize_post_fields(selected))


@query(
    "drop_accounting",
    o.dirty_sql(
        "SELECT count(*) AS rows_before, count(*) FILTER (final_text = '') AS rows_dropped, "
        "count(*) FILTER (final_text <> '') AS rows_remaining FROM final"
    ),
)
def drop_accounting(spark, sf):
    final = post_ops.with_final_text(post_ops.select_fields(fx.dirty_posts(spark, sf)))
    return post_ops.drop_accounting(final, F.col("final_text") != "")


# --- scalar functions -----------------------------------------------------------------------------------


@query(
    "clean_text",
    f"WITH x AS (SELECT doc_id, {o.clean(o.ADVERSARIAL_TEXT)} AS c FROM documents) "
    "SELECT doc_id, md5(c) AS cleaned_md5, length(c) AS chars FROM x",
)
def clean_text(spark, sf):
    cleaned = guards.compute_once(fx.adversarial_text(spark, sf), c=text.clean_text(F.col("text")))
    return cleaned.select("doc_id", F.md5("c").alias("cleaned_md5"), F.length("c").cast("bigint").alias("chars"))


_NORMALIZED = ("id", "subreddit", "author", "title", "body")


def _normalize_query(name: str, spark_fn, sql_fn, columns: tuple[str, ...]):
    sql = o.dirty_sql(f"SELECT doc_id, {', '.join(f'md5({sql_fn(c)}) AS {c}_md5' for c in columns)} FROM dirty")

    @query(name, sql)
    def run(spark, sf):
        posts = fx.dirty_posts(spark, sf)
        return posts.select("doc_id", *[F.md5(spark_fn(F.col(c))).alias(f"{c}_md5") for c in columns])

    return run


_normalize_query("normalize_text", text.normalize_text, o.norm, _NORMALIZED)
_normalize_query("normalize_text_placeholders", text.normalize_text_placeholders, o.norm_placeholder, _NORMALIZED)
_normalize_query("normalize_author", text.normalize_author, o.norm_author, ("author",))
_normalize_query("normalize_group_key", text.normalize_key, o.norm_key, ("subreddit", "author"))


@query(
    "normalize_sentiment_label",
    o.tagged_sql("SELECT id, coalesce(predicted_sentiment, '') AS predicted_sentiment FROM t"),
)
def normalize_sentiment_label(spark, sf):
    shouted = F.concat(F.lit(" "), F.upper("predicted_sentiment"), F.lit("\n"))
    return fx.tagged(spark, sf).select("id", text.normalize_key(shouted).alias("predicted_sentiment"))


_EPOCHS = "CASE doc_id % 4 WHEN 0 THEN created_utc::DOUBLE WHEN 1 THEN created_utc + 0.5 WHEN 2 THEN NULL ELSE 1e300 END"


def _epochs(spark, sf) -> DataFrame:
    t = F.col("created_utc").cast("double")
    place = F.col("doc_id") % 4
    value = F.when(place == 0, t).when(place == 1, t + 0.5).when(place == 3, F.lit(1e300))
    return fx.posts(spark, sf).select("id", value.alias("created_utc"))


@query(
    "epoch_to_timestamp",
    f"""WITH {o.POSTS}, e AS (SELECT id, {_EPOCHS} AS s FROM posts)
    SELECT id, CASE WHEN abs(s) <= 9223372036 THEN make_timestamp((s * 1000000)::BIGINT) END AS created_datetime_utc FROM e""",
)
def epoch_to_timestamp(spark, sf):
    stamp = dates.epoch_to_timestamp(F.col("created_utc"), "double").cast("timestamp_ntz")
    return _epochs(spark, sf).select("id", stamp.alias("created_datetime_utc"))


@query("calendar_parts", o.tagged_sql("SELECT id, year, month, year_month FROM t"))
def calendar_parts(spark, sf):
    return tagging.add_time_columns(fx.posts(spark, sf), STUDY).select("id", "year", "month", "year_month")


@query(
    "assign_time_period",
    """SELECT o_orderkey, CASE WHEN y IS NULL THEN 'unknown' WHEN y BETWEEN 1995 AND 1996 THEN 'early'
    WHEN y BETWEEN 1997 AND 1998 THEN 'mid' WHEN y >= 1999 THEN 'late' ELSE 'outside-study-range' END AS time_period
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN 1990
      ELSE year(o_orderdate) END AS y FROM orders)""",
)
def assign_time_period(spark, sf):
    place = F.col("o_orderkey") % 10
    year = F.when(place == 1, F.lit(1990)).when(place != 0, F.year("o_orderdate"))
    orders = fx.table(spark, sf, "orders").select("o_orderkey", year.alias("y"))
    return orders.select("o_orderkey", dates.assign_time_period(F.col("y"), STUDY.periods).alias("time_period"))


@query(
    "safe_divide",
    f"SELECT l_orderkey, l_linenumber, {o.r6(o.sdiv('l_extendedprice', 'l_linenumber % 3'))} AS ratio FROM lineitem",
)
def safe_divide(spark, sf):
    ratio = numeric.safe_divide(F.col("l_extendedprice"), F.col("l_linenumber") % 3)
    return rounded(fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", ratio.alias("ratio")))


# How far the mean quantity of an order's lines is from that of quantities spread evenly over 1 to 50.
_Z = "(SELECT l_orderkey, round((avg(l_quantity) - 25.5) * sqrt(count(*)) / 14.43, 6) AS z FROM lineitem GROUP BY 1)"


def _z_values(spark, sf) -> DataFrame:
    z = (F.avg("l_quantity") - 25.5) * F.sqrt(F.count(F.lit(1)).cast("double")) / 14.43
    return fx.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.round(z, 6).alias("z"))


@query("normal_cdf", f"SELECT l_orderkey, round({o.cdf('z')}, 9) AS cdf FROM {_Z}")
def normal_cdf(spark, sf):
    return rounded(_z_values(spark, sf).select("l_orderkey", numeric.normal_cdf(F.col("z")).alias("cdf")), 9)


@query("p_value_two_sided", f"SELECT l_orderkey, round({o.p_value('z')}, 9) AS p_value FROM {_Z}")
def p_value_two_sided(spark, sf):
    return rounded(_z_values(spark, sf).select("l_orderkey", numeric.p_value_two_sided(F.col("z")).alias("p_value")), 9)


@query(
    "prepare_topic_patterns",
    f"""WITH raw(topic_bucket, keyword, pos) AS (VALUES
    {', '.join(f"('{t.name}', {o.quote(k)}, {i})" for t in STUDY.topics for i, k in enumerate(t.keywords))}),
    k AS (SELECT topic_bucket, keyword, {o.clean('keyword')} AS cleaned, pos FROM raw),
    d AS (SELECT *, row_number() OVER (PARTITION BY topic_bucket, cleaned ORDER BY pos) AS r FROM k WHERE cleaned <> ''),
    {o.TAGGED}, b AS (SELECT c FROM whole)
    SELECT topic_bucket, keyword, cleaned, count(b.c) AS posts FROM d
    LEFT JOIN b ON contains(' ' || b.c || ' ', ' ' || d.cleaned || ' ') WHERE r = 1 GROUP BY ALL""",
)
def prepare_topic_patterns(spark, sf):
    texts = post_ops.with_cleaned_text(fx.final_texts(spark, sf), "final_text")
    prepared = [(t.name, k) for t in STUDY.topics for k in prepare_keywords(t)]
    found = texts.agg(
        *[F.count_if(contains_phrase(F.col("cleaned_text"), k.cleaned)).alias(f"n{i}") for i, (_, k) in enumerate(prepared)]
    )
    entries = [
        F.struct(
            F.lit(name).alias("topic_bucket"), F.lit(k.raw).alias("keyword"), F.lit(k.cleaned).alias("cleaned"),
            F.col(f"n{i}").alias("posts"),
        )
        for i, (name, k) in enumerate(prepared)
    ]
    return found.select(F.inline(F.array(*entries)))


@query(
    "keyword_phrase_match",
    o.tagged_sql(f"SELECT id, {o.has('c', 'from the')} AS phrase, {o.has('c', 're')} AS word FROM t"),
)
def keyword_phrase_match(spark, sf):
    texts = post_ops.with_cleaned_text(fx.final_texts(spark, sf), "final_text")
    c = F.col("cleaned_text")
    return texts.select("id", contains_phrase(c, "from the").alias("phrase"), contains_phrase(c, "re").alias("word"))


_MATCHED = [matched_column(n) for n in STUDY.topic_names]


def _tag_query(name: str, columns: list[str]):
    @query(name, o.tagged_sql(f"SELECT id, {', '.join(columns)} FROM t"))
    def run(spark, sf):
        return fx.tagged(spark, sf).select("id", *columns)

    return run


_tag_query("matched_keywords", _MATCHED)
_tag_query("topic_list", ["topic_list"])
_tag_query("num_topics", ["num_topics"])
_tag_query("has_any_topic", ["has_any_topic"])
_tag_query("label_to_sentiment", ["predicted_label", "predicted_sentiment"])


@query(
    "sentiment_delta",
    o.tagged_sql(
        f"""SELECT topic_bucket, {o.r6(o.sdiv('count(*) FILTER (predicted_label = 1)', 'count(*)')
        + ' - (SELECT avg(predicted_label) FROM v)')} AS delta FROM vl GROUP BY topic_bucket"""
    ),
)
def sentiment_delta(spark, sf):
    table = sentiment.topic_sentiment_table(fx.rows(spark, sf), STUDY).filter(F.col("total_posts") > 0)
    return rounded(table.select("topic_bucket", F.col("positive_rate_minus_overall").alias("delta")))


# --- joins ----------------------------------------------------------------------------------------------


@query(
    "semi_join_eligible_authors",
    o.tagged_sql(
        f"""SELECT id, a AS author_norm, predicted_label AS label FROM (SELECT *, {o.norm_author('author')} AS a FROM v)
        WHERE a IN (SELECT a FROM (SELECT {o.norm_author('author')} AS a FROM v) WHERE a <> '' GROUP BY a HAVING count(*) >= 3)"""
    ),
)
def semi_join_eligible_authors(spark, sf):
    posts = fx.tagged(spark, sf)
    label = numeric.numeric_column(posts, "predicted_label", numeric.coerce_label)
    rows = posts.select("id", text.normalize_author(F.col("author")).alias("author_norm"), label.alias("label"))
    rows = rows.filter((F.col("author_norm") != "") & F.col("label").isNotNull())
    return users.semi_join_eligible_authors(rows, STUDY.min_user_posts)


@query(
    "align_join_group_aggregates",
    o.tagged_sql(
        "SELECT year_month, subreddit, count(*) AS total_posts, sum(topic_alpha)::BIGINT AS alpha_posts FROM t GROUP BY ALL"
    ),
)
def align_join_group_aggregates(spark, sf):
    return fx.rows(spark, sf).groupBy("year_month", "subreddit").agg(
        total().alias("total_posts"), total("posts", F.col("topic_alpha") == 1).alias("alpha_posts")
    )


_CALENDAR = """bounds AS (SELECT min(date_trunc('month', ts)) AS lo, max(date_trunc('month', ts)) AS hi FROM {src}),
months AS (SELECT strftime(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)), '%Y-%m') AS year_month FROM bounds)"""


@query(
    "calendar_left_join",
    o.tagged_sql(
        "SELECT year_month, coalesce(n, 0) AS posts FROM months LEFT JOIN "
        "(SELECT year_month, count(*) AS n FROM v WHERE predicted_label = 0 GROUP BY 1) USING (year_month)",
        _CALENDAR.format(src="v WHERE predicted_label = 0"),
    ),
)
def calendar_left_join(spark, sf):
    negative = valid(fx.rows(spark, sf)).filter(F.col("label") == 0)
    monthly = negative.groupBy("year_month").agg(total().alias("posts"))
    return trends.fill_month_gaps(monthly, ["posts"])


@query(
    "month_topic_scaffold",
    o.tagged_sql(
        "SELECT year_month, topic_bucket, coalesce(n, 0) AS topic_post_count FROM months CROSS JOIN topics LEFT JOIN "
        "(SELECT year_month, topic_bucket, count(*) AS n FROM tl GROUP BY ALL) USING (year_month, topic_bucket)",
        _CALENDAR.format(src="t"),
    ),
)
def month_topic_scaffold(spark, sf):
    long = trends.topic_monthly_trends_long(fx.rows(spark, sf), STUDY)
    return long.select("year_month", "topic_bucket", "topic_post_count")


@query(
    "period_dimension_join",
    o.tagged_sql(
        "SELECT period_ord, time_period, count(v.id) AS total_posts FROM periods LEFT JOIN "
        "(SELECT * FROM v WHERE time_period <> 'mid') v USING (time_period) GROUP BY ALL"
    ),
)
def period_dimension_join(spark, sf):
    rows = fx.rows(spark, sf).filter(F.col("time_period") != "mid")
    table = sentiment.period_sentiment_table(rows, STUDY)
    order = F.array_position(F.array(*[F.lit(p) for p in STUDY.period_names]), F.col("time_period")) - 1
    return table.select(order.cast("int").alias("period_ord"), "time_period", "total_posts")


@query(
    "topic_dimension_lookup",
    o.tagged_sql("SELECT id, topic_bucket, topic_description FROM tl JOIN topics USING (topic_bucket)"),
)
def topic_dimension_lookup(spark, sf):
    return tagging.topic_post_long(fx.tagged(spark, sf), STUDY, ("id",))


@query(
    "overall_baseline_cross_join",
    o.tagged_sql(
        f"""SELECT topic_bucket, (SELECT {o.r6('avg(predicted_label)')} FROM v) AS overall_positive_rate,
        (SELECT {o.r6('1 - avg(predicted_label)')} FROM v) AS overall_negative_rate FROM topics"""
    ),
)
def overall_baseline_cross_join(spark, sf):
    summary = sentiment.topic_sentiment_summary(fx.rows(spark, sf), STUDY)
    return rounded(summary.select("topic_bucket", "overall_positive_rate", "overall_negative_rate"))


_VOCAB = o.vocabulary("terms", "docs", features.MAX_FEATURES)


def _all_terms(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ids of the documents, term counts (written once, as two passes read them) and vocabulary."""
    docs = fx.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"))
    terms = durable(features.term_counts(fx.cleaned_docs(spark, sf)))
    frequencies = durable(features.document_frequency(terms, docs))
    return docs, terms, durable(features.vocabulary_topn(frequencies))


@query(
    "vocabulary_join",
    o.docs_sql(
        f"SELECT docs.id, count(vocab.term) AS known_terms, {o.r6('coalesce(sum(vocab.idf), 0.0)')} AS idf_sum FROM docs "
        "LEFT JOIN terms USING (id) LEFT JOIN vocab USING (term) GROUP BY docs.id",
        _VOCAB,
    ),
)
def vocabulary_join(spark, sf):
    docs, terms, vocabulary = _all_terms(spark, sf)
    model = vocabulary.select("term", "idf")
    known = features.attach_vocabulary(terms, model)
    sums = known.groupBy("id").agg(F.count(F.lit(1)).alias("known_terms"), F.sum("idf").alias("idf_sum"))
    kept = docs.select("id").join(sums, "id", "left")
    return rounded(kept.fillna(0, ["known_terms"]).fillna(0.0, ["idf_sum"]))


# --- aggregations -----------------------------------------------------------------------------------------


@query(
    "label_distribution",
    o.tagged_sql(
        f"SELECT predicted_sentiment, count(*) AS posts, {o.r6('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct "
        "FROM t GROUP BY predicted_sentiment"
    ),
)
def label_distribution(spark, sf):
    return rounded(sentiment.label_distribution(fx.tagged(spark, sf)))


_COUNT_SENTIMENT = (
    "count(*) FILTER (predicted_sentiment = 'negative') AS negative, "
    "count(*) FILTER (predicted_sentiment = 'positive') AS positive"
)


@query("sentiment_by_group_crosstab", o.tagged_sql(f"SELECT subreddit, {_COUNT_SENTIMENT} FROM v GROUP BY subreddit"))
def sentiment_by_group_crosstab(spark, sf):
    return sentiment.sentiment_by_group_crosstab(fx.tagged(spark, sf))


@query("sentiment_by_period_crosstab", o.tagged_sql(f"SELECT time_period, {_COUNT_SENTIMENT} FROM v GROUP BY time_period"))
def sentiment_by_period_crosstab(spark, sf):
    return sentiment.sentiment_by_period_crosstab(fx.tagged(spark, sf))


def _timed(spark, sf) -> DataFrame:
    """Posts with calendar columns; every fourth has no time."""
    no_time = F.when(F.col("doc_id") % 4 != 0, F.col("created_utc"))
    return tagging.add_time_columns(fx.posts(spark, sf).withColumn("created_utc", no_time), STUDY)


@query(
    "posts_by_month",
    o.tagged_sql("SELECT CASE WHEN doc_id % 4 <> 0 THEN year_month END AS year_month, count(*) AS posts FROM t GROUP BY 1"),
)
def posts_by_month(spark, sf):
    return sentiment.posts_by_month(_timed(spark, sf))


@query(
    "posts_by_period",
    o.tagged_sql("SELECT CASE WHEN doc_id % 4 <> 0 THEN time_period ELSE 'unknown' END AS time_period, count(*) AS posts FROM t GROUP BY 1"),
)
def posts_by_period(spark, sf):
    return sentiment.posts_by_period(_timed(spark, sf))


@query(
    "topic_coverage",
    o.tagged_sql(
        f"""SELECT topic_bucket, topic_rows, {o.r6('100.0 * topic_rows / (SELECT count(*) FROM t)')} AS topic_pct FROM (
        SELECT topics.topic_bucket, count(tl.id) AS topic_rows FROM topics LEFT JOIN tl USING (topic_bucket) GROUP BY 1
        UNION ALL SELECT 'any_topic', sum(has_any_topic)::BIGINT FROM t)"""
    ),
)
def topic_coverage(spark, sf):
    return rounded(tagging.topic_coverage(fx.tagged(spark, sf), STUDY))


@query("num_topics_distribution", o.tagged_sql("SELECT num_topics, count(*) AS posts FROM t GROUP BY num_topics"))
def num_topics_distribution(spark, sf):
    return tagging.num_topics_distribution(fx.tagged(spark, sf))


@query(
    "topic_counts_by_group",
    o.tagged_sql(
        "SELECT subreddit, "
        + ", ".join(f"sum({topic_column(n)})::BIGINT AS {topic_column(n)}" for n in STUDY.topic_names)
        + " FROM t GROUP BY subreddit"
    ),
)
def topic_counts_by_group(spark, sf):
    return tagging.topic_counts_by_group(fx.tagged(spark, sf), STUDY)


_TAGGED_POSTS = "sum(has_any_topic)::BIGINT AS posts_with_any_topic"
_TAGGED_SHARE = f"{o.r6(o.sdiv('posts_with_any_topic', 'total_posts'))} AS share_posts_with_any_topic"


@query(
    "overall_summary",
    o.tagged_sql(
        f"""SELECT total_posts, positive_posts, negative_posts, {o.RATES}, num_subreddits, num_months, num_time_periods,
        posts_with_any_topic, {_TAGGED_SHARE}, {o.r6('app')} AS avg_prob_positive, {o.r6('apn')} AS avg_prob_negative
        FROM (SELECT {o.SENTIMENT}, count(DISTINCT subreddit) AS num_subreddits, count(DISTINCT year_month) AS num_months,
        count(DISTINCT time_period) AS num_time_periods, {_TAGGED_POSTS}, {o.PROBS} FROM v)"""
    ),
)
def overall_summary(spark, sf):
    return rounded(sentiment.overall_summary(fx.rows(spark, sf)))


@query(
    "sentiment_summary",
    o.tagged_sql(f"SELECT 'alpha posts' AS group_name, {o.SUMMARY} FROM (SELECT {o.SENTIMENT}, {o.PROBS} FROM v WHERE topic_alpha = 1)"),
)
def sentiment_summary(spark, sf):
    subset = fx.rows(spark, sf).filter(F.col("topic_alpha") == 1)
    return rounded(sentiment.sentiment_summary(subset, "alpha posts"))


@query(
    "period_sentiment_table",
    o.tagged_sql(
        f"""SELECT time_period, total_posts, positive_posts, negative_posts, {o.RATES}, posts_with_any_topic, {_TAGGED_SHARE}
        FROM (SELECT time_period, count(v.id) AS total_posts, count(*) FILTER (predicted_label = 1) AS positive_posts,
        count(*) FILTER (predicted_label = 0) AS negative_posts, coalesce(sum(has_any_topic), 0)::BIGINT AS posts_with_any_topic
        FROM periods LEFT JOIN v USING (time_period) GROUP BY time_period)"""
    ),
)
def period_sentiment_table(spark, sf):
    return rounded(sentiment.period_sentiment_table(fx.rows(spark, sf), STUDY))


@query(
    "group_sentiment_table",
    o.tagged_sql(f"SELECT subreddit, total_posts, positive_posts, negative_posts, {o.RATES} FROM (SELECT subreddit, {o.SENTIMENT} FROM v GROUP BY subreddit)"),
)
def group_sentiment_table(spark, sf):
    return rounded(sentiment.group_sentiment_table(fx.rows(spark, sf)))


@query(
    "monthly_sentiment_table",
    o.tagged_sql(
        f"""SELECT year_month, total_posts, positive_posts, negative_posts, {o.RATES}, posts_with_any_topic, {_TAGGED_SHARE}
        FROM (SELECT year_month, {o.SENTIMENT}, {_TAGGED_POSTS} FROM v GROUP BY year_month)"""
    ),
)
def monthly_sentiment_table(spark, sf):
    return rounded(sentiment.monthly_sentiment_table(fx.rows(spark, sf)))


_PER_TOPIC = f"""(SELECT topic_ord, topic_bucket, topic_description, count(vl.id) AS total_posts,
  count(*) FILTER (predicted_label = 1) AS positive_posts, count(*) FILTER (predicted_label = 0) AS negative_posts, {o.PROBS}
  FROM topics LEFT JOIN vl USING (topic_bucket) GROUP BY ALL)"""
_TOPIC_TABLE = f"""SELECT topic_bucket, topic_description, total_posts, positive_posts, negative_posts, {o.RATES},
  {o.r6('total_posts::DOUBLE / (SELECT count(*) FROM v)')} AS share_of_all_posts,
  CASE WHEN total_posts > 0 THEN {o.r6(o.sdiv('positive_posts', 'total_posts') + ' - (SELECT avg(predicted_label) FROM v)')} END
    AS positive_rate_minus_overall, {o.r6('app')} AS avg_prob_positive FROM {_PER_TOPIC}"""


@query("topic_sentiment_table", o.tagged_sql(_TOPIC_TABLE))
def topic_sentiment_table(spark, sf):
    return rounded(sentiment.topic_sentiment_table(fx.rows(spark, sf), STUDY))


_TOPIC_SUMMARY = f"""summary AS (SELECT topic_ord, topic_bucket, topic_description, {o.SUMMARY},
  {o.sdiv('positive_posts', 'total_posts')} AS pr, {o.sdiv('negative_posts', 'total_posts')} AS nr,
  (SELECT avg(predicted_label) FROM v) AS opr, (SELECT avg(1 - predicted_label) FROM v) AS onr FROM {_PER_TOPIC}),
topic_summary AS (SELECT * EXCLUDE (pr, nr, opr, onr), {o.r6('opr')} AS overall_positive_rate,
  {o.r6('onr')} AS overall_negative_rate, {o.r6('pr - opr')} AS positive_rate_minus_overall,
  {o.r6('nr - onr')} AS negative_rate_minus_overall FROM summary)"""


@query("topic_sentiment_summary", o.tagged_sql("SELECT * EXCLUDE (topic_ord) FROM topic_summary", _TOPIC_SUMMARY))
def topic_sentiment_summary(spark, sf):
    return rounded(sentiment.topic_sentiment_summary(fx.rows(spark, sf), STUDY).drop("topic_ord"))


def _rank_query(side: str):
    sql = o.tagged_sql(
        f"""SELECT row_number() OVER (ORDER BY {side}_rate DESC, total_posts DESC, topic_ord)::INTEGER AS {side}_rank,
        * EXCLUDE (topic_ord) FROM topic_summary""",
        _TOPIC_SUMMARY,
    )

    @query(f"rank_topics_{side}", sql)
    def run(spark, sf):
        return rounded(sentiment.rank_topics(sentiment.topic_sentiment_summary(fx.rows(spark, sf), STUDY), side))

    return run


_rank_query("positive")
_rank_query("negative")


@query(
    "topk_topics",
    o.tagged_sql(
        " UNION ALL ".join(
            f"SELECT * FROM (SELECT '{name}' AS ranking, row_number() OVER (ORDER BY {c} DESC, topic_bucket)::INTEGER AS place, "
            f"topic_bucket, {c}::DOUBLE AS value, total_posts FROM table_) WHERE place <= 3"
            + ("" if name == "frequency" else " AND total_posts > 0")
            for name, c in (("frequency", "total_posts"), ("positive", "positive_rate"), ("negative", "negative_rate"))
        ),
        f"table_ AS ({_TOPIC_TABLE})",
    ),
)
def topk_topics(spark, sf):
    return rounded(sentiment.topk_topics(sentiment.topic_sentiment_table(fx.rows(spark, sf), STUDY)))


@query(
    "chart_period_rates",
    o.tagged_sql(f"SELECT time_period, {o.r6('avg(predicted_label)')} AS positive_rate, count(*) AS total_posts FROM v GROUP BY 1"),
)
def chart_period_rates(spark, sf):
    return rounded(sentiment.chart_rates(sentiment.period_sentiment_table(fx.rows(spark, sf), STUDY), "time_period"))


def _chart_topic(name: str, order: str):
    sql = o.tagged_sql(
        f"SELECT *, row_number() OVER (ORDER BY {order} DESC, topic_bucket) - 1 AS place FROM (SELECT topic_bucket, "
        f"{o.r6('avg(predicted_label)')} AS positive_rate, count(*) AS total_posts FROM vl GROUP BY 1)"
    )

    @query(name, sql)
    def run(spark, sf):
        table = sentiment.topic_sentiment_table(fx.rows(spark, sf), STUDY)
        return rounded(numbered(sentiment.chart_rates(table, "topic_bucket", order), "place"))

    return run


_chart_topic("chart_topic_rates", "positive_rate")
_chart_topic("chart_topic_frequency", "total_posts")

_TOPIC_MONTHLY = f"""(SELECT m.year_month, topic_bucket, topic_description, n AS total_posts_in_month,
  coalesce(k, 0) AS topic_posts_in_month, coalesce(p, 0) AS positive, coalesce(q, 0) AS negative
  FROM (SELECT year_month, count(*) AS n FROM v GROUP BY 1) m CROSS JOIN topics LEFT JOIN
  (SELECT year_month, topic_bucket, count(*) AS k, count(*) FILTER (predicted_label = 1) AS p,
   count(*) FILTER (predicted_label = 0) AS q FROM vl GROUP BY ALL) x USING (year_month, topic_bucket))"""


@query(
    "topic_monthly_table",
    o.tagged_sql(
        f"""SELECT year_month, topic_bucket, topic_description, total_posts_in_month, topic_posts_in_month,
        {o.r6(o.sdiv('topic_posts_in_month', 'total_posts_in_month'))} AS topic_share_of_all_posts,
        {o.r6(o.sdiv('positive', 'topic_posts_in_month'))} AS topic_positive_rate,
        {o.r6(o.sdiv('negative', 'topic_posts_in_month'))} AS topic_negative_rate FROM {_TOPIC_MONTHLY}"""
    ),
)
def topic_monthly_table(spark, sf):
    return rounded(sentiment.topic_monthly_table(fx.rows(spark, sf), STUDY))


@query(
    "indexed_topic_trend",
    o.tagged_sql(
        f"""SELECT year_month, topic_bucket, {o.r6('coalesce(100.0 * topic_posts_in_month / base, 0.0)')} AS indexed_count
        FROM {_TOPIC_MONTHLY} LEFT JOIN (SELECT topic_bucket, arg_min(topic_posts_in_month, year_month) AS base
          FROM {_TOPIC_MONTHLY} WHERE topic_posts_in_month > 0 GROUP BY 1) USING (topic_bucket)"""
    ),
)
def indexed_topic_trend(spark, sf):
    return rounded(sentiment.indexed_topic_trend(sentiment.topic_monthly_table(fx.rows(spark, sf), STUDY)))


@query(
    "topics_by_total_volume",
    o.tagged_sql(
        "SELECT *, row_number() OVER (ORDER BY total_volume DESC, topic_bucket) - 1 AS place FROM (SELECT topic_bucket, "
        "count(vl.id) AS total_volume FROM topics LEFT JOIN vl USING (topic_bucket) GROUP BY 1)"
    ),
)
def topics_by_total_volume(spark, sf):
    return numbered(sentiment.topics_by_total_volume(sentiment.topic_monthly_table(fx.rows(spark, sf), STUDY)), "place")


@query(
    "topic_post_long",
    o.tagged_sql(
        "SELECT id, subreddit, year_month, time_period, predicted_label, predicted_sentiment, "
        f"{o.r6('prob_negative')} AS prob_negative, {o.r6('prob_positive')} AS prob_positive, topic_bucket, "
        "topic_description FROM vl JOIN topics USING (topic_bucket)"
    ),
)
def topic_post_long(spark, sf):
    labelled = fx.tagged(spark, sf).filter(F.col("predicted_label").isin(0, 1))
    return rounded(tagging.topic_post_long(labelled, STUDY, POST_COLUMNS))


# --- trends -------------------------------------------------------------------------------------------------

_DENSE = _CALENDAR.format(src="t") + """,
totals AS (SELECT year_month, count(*) AS n, sum(has_any_topic)::BIGINT AS g FROM t GROUP BY 1),
counts AS (SELECT year_month, topic_bucket, count(*) AS k FROM tl GROUP BY ALL),
trend AS (SELECT year_month, topic_bucket, topic_description, coalesce(n, 0) AS total_posts_in_month,
  coalesce(g, 0) AS topic_tagged_posts_in_month, coalesce(k, 0) AS topic_post_count
  FROM months CROSS JOIN topics LEFT JOIN totals USING (year_month) LEFT JOIN counts USING (year_month, topic_bucket))"""


def _share_sql(all_posts: str, tagged_posts: str) -> str:
    return (
        f"{o.r6(o.sdiv('topic_post_count', all_posts))} AS topic_share_of_all_posts, "
        f"{o.r6(o.sdiv('topic_post_count', tagged_posts))} AS topic_share_of_topic_tagged_posts"
    )


_TREND_LONG = f"SELECT *, {_share_sql('total_posts_in_month', 'topic_tagged_posts_in_month')} FROM trend"


@query("full_month_index", o.tagged_sql("SELECT year_month FROM months", _CALENDAR.format(src="t")))
def full_month_index(spark, sf):
    return trends.full_month_index(fx.rows(spark, sf))


@query(
    "sort_months",
    o.tagged_sql("SELECT year_month, row_number() OVER (ORDER BY year_month) - 1 AS place FROM (SELECT DISTINCT year_month FROM t)"),
)
def sort_months(spark, sf):
    return numbered(trends.sort_months(fx.rows(spark, sf)), "place")


@query(
    "monthly_post_totals",
    o.tagged_sql(
        "SELECT year_month, coalesce(n, 0) AS total_posts_in_month, coalesce(g, 0) AS topic_tagged_posts_in_month "
        "FROM months LEFT JOIN totals USING (year_month)",
        _DENSE,
    ),
)
def monthly_post_totals(spark, sf):
    return trends.monthly_post_totals(fx.rows(spark, sf), STUDY)


@query("topic_monthly_trends_long", o.tagged_sql(_TREND_LONG, _DENSE))
def topic_monthly_trends_long(spark, sf):
    return rounded(trends.topic_monthly_trends_long(fx.rows(spark, sf), STUDY))


@query("incremental_monthly_trends", o.tagged_sql(_TREND_LONG, _DENSE))
def incremental_monthly_trends(spark, sf):
    """The same trends from three batches put one by one, each with late posts of the others' months. The batches are
    cut from one table, so that no text is cleaned and searched once for each of them."""
    store, tagged = cube_store.CubeStore(spark, fx.fresh(spark, "cubes"), STUDY), durable(fx.tagged(spark, sf))
    for i in range(3):
        store.put(f"batch-{i}", tagged.filter(F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(3)) == i))
    return rounded(trends.topic_monthly_trends_long(store.cube(), STUDY))


def _pivot_query(kind: str, value: str):
    columns = ", ".join(f"max({value}) FILTER (topic_bucket = '{n}') AS \"{n}\"" for n in sorted(STUDY.topic_names))
    sql = o.tagged_sql(f"SELECT year_month, {columns} FROM ({_TREND_LONG}) GROUP BY year_month", _DENSE)

    @query(f"trend_pivot_{kind}", sql)
    def run(spark, sf):
        long = trends.topic_monthly_trends_long(fx.rows(spark, sf), STUDY)
        return rounded(trends.trend_pivot(long, STUDY, kind))

    return run


for _kind, _value in trends.WIDE_VALUES.items():
    _pivot_query(_kind, _value)


@query(
    "topic_period_summary",
    o.tagged_sql(
        f"""SELECT time_period, topic_bucket, topic_description, total_posts_in_period, topic_tagged_posts_in_period,
        topic_post_count, {_share_sql('total_posts_in_period', 'topic_tagged_posts_in_period')} FROM (
        SELECT p.*, topic_bucket, topic_description, coalesce(k, 0) AS topic_post_count FROM
        (SELECT time_period, count(*) AS total_posts_in_period, sum(has_any_topic)::BIGINT AS topic_tagged_posts_in_period
         FROM t GROUP BY 1) p CROSS JOIN topics LEFT JOIN
        (SELECT time_period, topic_bucket, count(*) AS k FROM tl GROUP BY ALL) x USING (time_period, topic_bucket))"""
    ),
)
def topic_period_summary(spark, sf):
    return rounded(trends.topic_period_summary(fx.rows(spark, sf), STUDY))


@query(
    "topic_group_monthly_trends",
    o.tagged_sql(
        f"""SELECT year_month, subreddit, n AS total_posts_in_month_subreddit, coalesce(k, 0) AS topic_post_count,
        topic_bucket, topic_description, {o.r6(o.sdiv('coalesce(k, 0)', 'n'))} AS topic_share_of_all_posts FROM
        (SELECT year_month, subreddit, count(*) AS n FROM t GROUP BY ALL) CROSS JOIN topics LEFT JOIN
        (SELECT year_month, subreddit, topic_bucket, count(*) AS k FROM tl GROUP BY ALL) x
        USING (year_month, subreddit, topic_bucket)"""
    ),
)
def topic_group_monthly_trends(spark, sf):
    return rounded(trends.topic_group_monthly_trends(fx.rows(spark, sf), STUDY))


@query(
    "topic_overall_frequency",
    o.tagged_sql(
        f"""SELECT topic_bucket, count(tl.id) AS topic_post_count,
        {o.r6('count(tl.id)::DOUBLE / (SELECT count(*) FROM t)')} AS topic_share_of_all_posts
        FROM topics LEFT JOIN tl USING (topic_bucket) GROUP BY topic_bucket"""
    ),
)
def topic_overall_frequency(spark, sf):
    return rounded(trends.topic_overall_frequency(fx.rows(spark, sf), STUDY))


# --- users --------------------------------------------------------------------------------------------------

_USERS = f"""u AS (SELECT *, {o.norm_author('author')} AS author_norm FROM v),
eligible AS (SELECT author_norm FROM u WHERE author_norm <> '' GROUP BY 1 HAVING count(*) >= 3),
ul AS (SELECT author_norm, topic_bucket, count(*) AS posts_in_topic, avg(predicted_label) AS lab, {o.PROBS}
  FROM (SELECT *, {o.norm_author('author')} AS author_norm FROM vl) SEMI JOIN eligible USING (author_norm) GROUP BY ALL),
pairs AS (SELECT a.topic_bucket AS topic_a, b.topic_bucket AS topic_b, {o.corr('a.lab', 'b.lab')} AS correlation
  FROM ul a JOIN ul b USING (author_norm) GROUP BY ALL),
used AS (SELECT DISTINCT topic_bucket FROM ul),
matrix AS (SELECT x.topic_bucket AS topic_a, y.topic_bucket AS topic_b, correlation FROM used x CROSS JOIN used y
  LEFT JOIN pairs ON pairs.topic_a = x.topic_bucket AND pairs.topic_b = y.topic_bucket)"""


def _author_rows(spark, sf) -> DataFrame:
    return users.author_topics(users.authored(fx.tagged(spark, sf), STUDY), STUDY)


@query(
    "author_post_counts",
    o.tagged_sql("SELECT author_norm, count(*) AS total_posts_by_user FROM u WHERE author_norm <> '' GROUP BY 1 HAVING count(*) >= 3", _USERS),
)
def author_post_counts(spark, sf):
    return users.author_post_counts(users.authored(fx.tagged(spark, sf), STUDY), STUDY.min_user_posts)


@query(
    "user_topic_sentiment_long",
    o.tagged_sql(
        f"""SELECT author_norm, posts_in_topic, {o.r6('lab')} AS avg_predicted_label, {o.r6('app')} AS avg_prob_positive,
        {o.r6('apn')} AS avg_prob_negative, topic_bucket, topic_description FROM ul JOIN topics USING (topic_bucket)""",
        _USERS,
    ),
)
def user_topic_sentiment_long(spark, sf):
    return rounded(users.user_topic_sentiment_long(_author_rows(spark, sf), STUDY))


@query(
    "topic_user_coverage",
    o.tagged_sql(
        f"""SELECT topic_bucket, count(DISTINCT author_norm) AS users_with_topic,
        sum(posts_in_topic)::BIGINT AS total_topic_posts_from_eligible_users, {o.r6('avg(lab)')} AS mean_user_topic_sentiment
        FROM ul GROUP BY topic_bucket""",
        _USERS,
    ),
)
def topic_user_coverage(spark, sf):
    long = users.user_topic_sentiment_long(_author_rows(spark, sf), STUDY)
    return rounded(users.topic_user_coverage(long))


@query(
    "user_topic_wide",
    o.tagged_sql(
        "SELECT author_norm, "
        + ", ".join(f"{o.r6(f'''max(lab) FILTER (topic_bucket = '{n}')''')} AS \"{n}\"" for n in sorted(STUDY.topic_names))
        + " FROM ul GROUP BY author_norm",
        _USERS,
    ),
)
def user_topic_wide(spark, sf):
    return rounded(users.user_topic_wide(_author_rows(spark, sf), STUDY))


@query(
    "h3_topic_correlation_matrix",
    o.tagged_sql(f"SELECT topic_a, topic_b, {o.r6('correlation')} AS correlation FROM matrix", _USERS),
)
def h3_topic_correlation_matrix(spark, sf):
    return rounded(users.topic_correlation_matrix(_author_rows(spark, sf), STUDY))


@query(
    "correlation_melt",
    o.tagged_sql(f"SELECT topic_a, topic_b, {o.r6('correlation')} AS correlation FROM matrix WHERE topic_a <> topic_b", _USERS),
)
def correlation_melt(spark, sf):
    return rounded(users.correlation_melt(users.topic_correlation_matrix(_author_rows(spark, sf), STUDY)))


@query(
    "h3_summary",
    o.tagged_sql(
        f"""SELECT 'H3' AS hypothesis, 3 AS min_user_posts, (SELECT count(*) FROM eligible) AS eligible_users,
        (SELECT count(*) FROM ul) AS user_topic_rows,
        (SELECT count(*) FROM used) AS num_topic_buckets_with_user_data,
        {o.r6('max(abs(correlation))')} AS max_abs_topic_correlation,
        coalesce(max(abs(correlation)) > 0, false) AS supports_h3_measurable_correlations,
        CASE WHEN (SELECT count(*) FROM ul) > 0
          THEN 'Correlation matrix based on user-level average predicted sentiment by topic.'
          ELSE 'Insufficient eligible user-topic data.' END AS note FROM matrix WHERE topic_a <> topic_b""",
        _USERS,
    ),
)
def h3_summary(spark, sf):
    return rounded(users.user_summary(_author_rows(spark, sf), STUDY))


# --- hypotheses -----------------------------------------------------------------------------------------------


@query(
    "two_proportion_z_test",
    "WITH g AS (SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS ka, "
    "count(*) FILTER (o_custkey % 2 = 0) AS na0, count(*) FILTER (o_orderstatus = 'F' AND o_custkey % 2 = 0) AS ka0, "
    "count(*) FILTER (o_custkey % 2 = 1) AS nb0, count(*) FILTER (o_orderstatus = 'F' AND o_custkey % 2 = 1) AS kb0 "
    "FROM orders GROUP BY 1) SELECT priority, "
    + (lambda d, z: f"{o.r6('ka0::DOUBLE / na0')} AS rate_a, {o.r6('kb0::DOUBLE / nb0')} AS rate_b, {o.r6(d)} AS diff_a_minus_b, "
       f"{o.r6(z)} AS z_stat, {o.r6(o.p_value('(' + z + ')'))} AS p_value_two_sided")(*o.z_test("ka0", "na0", "kb0", "nb0"))
    + " FROM g",
)
def two_proportion_z_test(spark, sf):
    f, even = F.col("o_orderstatus") == "F", F.col("o_custkey") % 2 == 0
    g = fx.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count_if(f & even).alias("ka"), F.count_if(even).alias("na"),
        F.count_if(f & ~even).alias("kb"), F.count_if(~even).alias("nb"),
    )
    t = numeric.two_proportion_z_test(*[F.col(c) for c in ("ka", "na", "kb", "nb")])
    return rounded(
        g.select(
            "priority", t.rate_a.alias("rate_a"), t.rate_b.alias("rate_b"), t.difference.alias("diff_a_minus_b"),
            t.z.alias("z_stat"), t.p.alias("p_value_two_sided"),
        )
    )


@query(
    "h1_period_summary",
    o.tagged_sql(
        f"""SELECT time_period AS group_name, {o.SUMMARY}, time_period FROM
        (SELECT time_period, {o.SENTIMENT}, {o.PROBS} FROM v WHERE topic_beta = 1 AND time_period IN ('early', 'late') GROUP BY 1)"""
    ),
)
def h1_period_summary(spark, sf):
    return rounded(hypotheses.recruiting_period_summary(fx.rows(spark, sf), STUDY))


_H1_POS, _H1_NEG = o.z_test("bp", "bn", "ap", "an"), o.z_test("bq", "bn", "aq", "an")


@query(
    "h1_proportion_test",
    o.tagged_sql(
        f"""SELECT 'H1' AS hypothesis, 'beta' AS topic_bucket, an AS pre_total_posts, bn AS post_total_posts,
        {o.r6(o.sdiv('ap', 'an'))} AS pre_positive_rate, {o.r6(o.sdiv('bp', 'bn'))} AS post_positive_rate,
        {o.r6(_H1_POS[0])} AS post_minus_pre_positive_rate, {o.r6(_H1_POS[1])} AS positive_rate_z_stat,
        {o.r6(o.p_value('(' + _H1_POS[1] + ')'))} AS positive_rate_p_value_two_sided,
        {o.r6(o.sdiv('aq', 'an'))} AS pre_negative_rate, {o.r6(o.sdiv('bq', 'bn'))} AS post_negative_rate,
        {o.r6(_H1_NEG[0])} AS post_minus_pre_negative_rate, {o.r6(_H1_NEG[1])} AS negative_rate_z_stat,
        {o.r6(o.p_value('(' + _H1_NEG[1] + ')'))} AS negative_rate_p_value_two_sided,
        an > 0 AND bn > 0 AND {o.sdiv('bp', 'bn')} < {o.sdiv('ap', 'an')} AND {o.sdiv('bq', 'bn')} > {o.sdiv('aq', 'an')}
          AS supports_h1_directionally,
        CASE WHEN an > 0 AND bn > 0 THEN 'H1 direction means late recruiting sentiment should be more negative than early.'
          ELSE 'Insufficient early or late recruiting data for direct comparison.' END AS note
        FROM (SELECT count(*) FILTER (time_period = 'early') AS an, count(*) FILTER (time_period = 'late') AS bn,
        count(*) FILTER (time_period = 'early' AND predicted_label = 1) AS ap,
        count(*) FILTER (time_period = 'late' AND predicted_label = 1) AS bp,
        count(*) FILTER (time_period = 'early' AND predicted_label = 0) AS aq,
        count(*) FILTER (time_period = 'late' AND predicted_label = 0) AS bq FROM v WHERE topic_beta = 1)"""
    ),
)
def h1_proportion_test(spark, sf):
    return rounded(hypotheses.recruiting_proportion_test(fx.rows(spark, sf), STUDY))


@query(
    "h2_frequency_by_period",
    o.tagged_sql(
        f"""SELECT time_period, count(v.id) AS total_posts, coalesce(sum(topic_alpha), 0)::BIGINT AS layoffs_posts,
        {o.r6(o.sdiv('coalesce(sum(topic_alpha), 0)', 'count(v.id)'))} AS layoffs_share_of_all_posts
        FROM periods LEFT JOIN v USING (time_period) GROUP BY time_period"""
    ),
)
def h2_frequency_by_period(spark, sf):
    return rounded(hypotheses.layoffs_frequency_by_period(fx.rows(spark, sf), STUDY))


_H2F = o.z_test("pk", "pn", "ek", "en")


@query(
    "h2_frequency_test",
    o.tagged_sql(
        f"""SELECT 'H2_frequency' AS hypothesis, 'late vs earlier (early + mid)' AS comparison, pn AS post_total_posts,
        pk AS post_layoffs_posts, {o.r6(o.sdiv('pk', 'pn'))} AS post_layoffs_share, en AS earlier_total_posts,
        ek AS earlier_layoffs_posts, {o.r6(o.sdiv('ek', 'en'))} AS earlier_layoffs_share,
        {o.r6(_H2F[0])} AS post_minus_earlier_layoffs_share, {o.r6(_H2F[1])} AS z_stat,
        {o.r6(o.p_value('(' + _H2F[1] + ')'))} AS p_value_two_sided,
        pn > 0 AND en > 0 AND {o.sdiv('pk', 'pn')} > {o.sdiv('ek', 'en')} AS supports_h2_frequency_directionally
        FROM (SELECT count(*) FILTER (time_period = 'late') AS pn, count(*) FILTER (time_period = 'late' AND topic_alpha = 1) AS pk,
        count(*) FILTER (time_period IN ('early', 'mid')) AS en,
        count(*) FILTER (time_period IN ('early', 'mid') AND topic_alpha = 1) AS ek FROM v)"""
    ),
)
def h2_frequency_test(spark, sf):
    return rounded(hypotheses.layoffs_frequency_test(fx.rows(spark, sf), STUDY))


_H2S = o.z_test("ak", "an", "bk", "bn")


@query(
    "h2_sentiment_tests",
    o.tagged_sql(
        f"""SELECT 'H2_sentiment' AS hypothesis, comparison_scope, an AS layoffs_total_posts,
        {o.r6(o.sdiv('ak', 'an'))} AS layoffs_positive_rate, bn AS non_layoffs_total_posts,
        {o.r6(o.sdiv('bk', 'bn'))} AS non_layoffs_positive_rate, {o.r6(_H2S[0])} AS layoffs_minus_non_layoffs_positive_rate,
        {o.r6(_H2S[1])} AS z_stat, {o.r6(o.p_value('(' + _H2S[1] + ')'))} AS p_value_two_sided,
        an > 0 AND bn > 0 AND {o.sdiv('ak', 'an')} < {o.sdiv('bk', 'bn')} AS supports_h2_lower_sentiment_directionally
        FROM (SELECT comparison_scope, count(*) FILTER (topic_alpha = 1) AS an,
        count(*) FILTER (topic_alpha = 1 AND predicted_label = 1) AS ak, count(*) FILTER (topic_alpha = 0) AS bn,
        count(*) FILTER (topic_alpha = 0 AND predicted_label = 1) AS bk FROM
        (SELECT 'overall' AS comparison_scope, * FROM v UNION ALL SELECT 'late only', * FROM v WHERE time_period = 'late')
        GROUP BY comparison_scope)"""
    ),
)
def h2_sentiment_tests(spark, sf):
    return rounded(hypotheses.layoffs_sentiment_tests(fx.rows(spark, sf), STUDY))


_AI_MONTHS = f"""ai AS (SELECT year_month, {o.SENTIMENT}, sum(topic_gamma)::BIGINT AS ai_posts, {o.PROBS} FROM v GROUP BY 1),
rates AS (SELECT *, {o.sdiv('ai_posts', 'total_posts')} AS share, {o.sdiv('positive_posts', 'total_posts')} AS pr,
  {o.sdiv('negative_posts', 'total_posts')} AS nr FROM ai)"""


@query(
    "h4_monthly_ai_sentiment",
    o.tagged_sql(
        f"""SELECT year_month, total_posts, ai_posts, {o.r6('share')} AS ai_share_of_all_posts,
        positive_posts AS overall_positive_posts, negative_posts AS overall_negative_posts,
        {o.r6('pr')} AS overall_positive_rate, {o.r6('nr')} AS overall_negative_rate,
        {o.r6('app')} AS overall_avg_prob_positive, {o.r6('apn')} AS overall_avg_prob_negative FROM rates""",
        _AI_MONTHS,
    ),
)
def h4_monthly_ai_sentiment(spark, sf):
    return rounded(hypotheses.monthly_ai_sentiment(fx.rows(spark, sf), STUDY))


@query(
    "h4_correlation",
    o.tagged_sql(
        f"""SELECT 'H4' AS hypothesis, count(*) AS num_months_available,
        {o.r6(o.corr('share', 'pr'))} AS ai_share_vs_overall_positive_rate_corr,
        {o.r6(o.corr('share', 'nr'))} AS ai_share_vs_overall_negative_rate_corr,
        count(*) >= 2 AS supports_h4_association_testable,
        CASE WHEN count(*) >= 2 THEN 'Correlation computed across monthly AI share and overall sentiment.'
          ELSE 'Correlation requires at least 2 months of data.' END AS note FROM rates""",
        _AI_MONTHS,
    ),
)
def h4_correlation(spark, sf):
    return rounded(hypotheses.ai_sentiment_correlation(hypotheses.monthly_ai_sentiment(fx.rows(spark, sf), STUDY)))


@query(
    "hypothesis_readiness",
    o.tagged_sql(
        """SELECT 'H1' AS hypothesis, 'Recruiting sentiment is more negative in late than early.' AS question,
          CASE WHEN a > 0 AND b > 0 THEN 'ready_for_real_test' ELSE 'not_fully_testable_with_current_sample' END
            AS status_with_current_data,
          'early recruiting posts=' || a || ', late recruiting posts=' || b AS current_result_note
        FROM (SELECT count(*) FILTER (time_period = 'early') AS a, count(*) FILTER (time_period = 'late') AS b FROM v
          WHERE topic_beta = 1)
        UNION ALL SELECT 'H2', 'Layoff-related posts increase after 2022 and have lower sentiment.',
          CASE WHEN n > 0 THEN 'partially_testable' ELSE 'not_observable_in_current_sample' END,
          'layoffs-topic posts in current dataset=' || n FROM (SELECT count(*) AS n FROM v WHERE topic_alpha = 1)
        UNION ALL SELECT 'H3', 'User-level sentiment differs by topic and produces cross-topic correlations.',
          CASE WHEN n > 0 THEN 'partially_testable' ELSE 'not_fully_testable_with_current_sample' END,
          'eligible users with >=3 posts=' || n
        FROM (SELECT count(*) AS n FROM (SELECT author FROM v WHERE trim(author) <> '' GROUP BY 1 HAVING count(*) >= 3))
        UNION ALL SELECT 'H4', 'AI-topic prevalence over time is associated with overall sentiment shifts.',
          CASE WHEN n >= 2 THEN 'ready_for_real_test' ELSE 'not_fully_testable_with_current_sample' END,
          'distinct months in dataset=' || n FROM (SELECT count(DISTINCT year_month) AS n FROM v)"""
    ),
)
def hypothesis_readiness(spark, sf):
    posts = fx.tagged(spark, sf)
    return hypotheses.hypothesis_readiness(posts, measured(posts, STUDY), STUDY)


# --- features and models -----------------------------------------------------------------------------------------


@query(
    "tokenize",
    o.docs_sql(
        "SELECT id, count(*) FILTER (length(term) >= 2) AS tokens, "
        "md5(coalesce(string_agg(term, ' ' ORDER BY pos) FILTER (length(term) >= 2), '')) AS tokens_md5 "
        "FROM (SELECT id, unnest(string_split(c, ' ')) AS term, generate_subscripts(string_split(c, ' '), 1) AS pos FROM docs) GROUP BY id"
    ),
)
def tokenize(spark, sf):
    tokens = features.tokenize(F.col("cleaned_text"))
    docs = fx.cleaned_docs(spark, sf).select("id", tokens.alias("t"))
    return docs.select("id", F.size("t").cast("bigint").alias("tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


@query(
    "document_frequency",
    o.docs_sql(f"SELECT term, doc_freq, corpus_freq, {o.r6('idf')} AS idf FROM freq", _VOCAB),
)
def document_frequency(spark, sf):
    terms = features.term_counts(fx.cleaned_docs(spark, sf))
    return rounded(features.document_frequency(terms, fx.table(spark, sf, "documents")))


@query(
    "vocabulary_topn",
    o.docs_sql(f"SELECT term, doc_freq, corpus_freq, {o.r6('idf')} AS idf FROM vocab", _VOCAB),
)
def vocabulary_topn(spark, sf):
    return rounded(_all_terms(spark, sf)[2])


@query(
    "tfidf_weights",
    o.docs_sql(f"SELECT id, term, {o.r6('weight')} AS weight FROM weights", _VOCAB + "," + o.WEIGHTS),
)
def tfidf_weights(spark, sf):
    _, terms, vocabulary = _all_terms(spark, sf)
    return rounded(features.tfidf_weights(terms, vocabulary))


@query("stratified_split", o.model_sql("SELECT id, label, split FROM split"))
def stratified_split(spark, sf):
    rows = durable(fx.labeled_docs(spark, sf))
    return models.stratified_split(rows).select("id", "label", "split")


@query(
    "train_naive_bayes",
    o.model_sql(f"SELECT term, {o.r6('idf')} AS idf, {o.r6('log_prob_0')} AS log_prob_0, {o.r6('log_prob_1')} AS log_prob_1 FROM nb"),
)
def train_naive_bayes(spark, sf):
    return rounded(_bayes(_train(spark, sf))[1])


@query(
    "predict_sentiment",
    f"""WITH {o.LABELED}, {o.REPEATED}
    SELECT 'naive_bayes' AS model, id, predicted_label, predicted_sentiment, {o.r6('prob_negative')} AS prob_negative,
      {o.r6('prob_positive')} AS prob_positive, true AS consistent FROM again_predicted
    UNION ALL SELECT 'logistic_regression', id, NULL, NULL, NULL, NULL, true FROM again WHERE c <> ''""",
)
def predict_sentiment(spark, sf):
    """Both models over documents of which some ids occur twice with different texts. The default model's
    figures SQL cannot give; of those, that they agree with each other."""
    train = _train(spark, sf)
    vocabulary = durable(models.fit_vocabulary(train))
    vectors = durable(features.document_vectors(train, vocabulary))
    bayes = models.naive_bayes_model(models.train_naive_bayes(vectors, vocabulary), models.class_log_prior(train))
    logistic = models.train_logistic_regression(vectors, vocabulary)
    texts = fx.texts(spark, sf, "doc_id", "text").withColumn("id", F.col("doc_id").cast("string"))
    first_line = F.split_part("text", F.lit("\n"), F.lit(1))
    texts = texts.unionByName(texts.filter(F.col("doc_id") % 10 == 0).withColumn("text", first_line))
    docs = durable(post_ops.keep_with_cleaned_text(texts, "text").select("id", "cleaned_text"))  # both models read them
    positive = F.col("prob_positive") > 0.5
    consistent = (
        (F.abs(F.col("prob_negative") + F.col("prob_positive") - 1.0) < 1e-9)
        & (F.col("predicted_label") == positive.cast("int"))
        & (F.col("predicted_sentiment") == F.when(positive, "positive").otherwise("negative"))
    ).alias("consistent")
    figures = ("predicted_label", "predicted_sentiment", "prob_negative", "prob_positive")
    of_bayes = models.predict_sentiment(docs, durable(bayes)).select(F.lit("naive_bayes").alias("model"), "id", *figures, consistent)
    of_logistic = models.predict_sentiment(docs, durable(logistic))
    hidden = [F.lit(None).cast(of_logistic.schema[c].dataType).alias(c) for c in figures]
    return rounded(of_bayes.unionByName(of_logistic.select(F.lit("logistic_regression").alias("model"), "id", *hidden, consistent)))


def _test_scored(spark, sf) -> DataFrame:
    split = _split(spark, sf)
    train, test = (split.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    return models.predict_sentiment(test, durable(_bayes_model(train)), keep=("label",))


_METRICS = f"""cm AS (SELECT c, count(*) FILTER (label = c AND predicted_label = c)::DOUBLE AS hit,
  count(*) FILTER (label = c)::DOUBLE AS support, count(*) FILTER (predicted_label = c)::DOUBLE AS called
  FROM test_scored CROSS JOIN (VALUES (0), (1)) k(c) GROUP BY c),
prf AS (SELECT c, {o.sdiv('hit', 'called')} AS p, {o.sdiv('hit', 'support')} AS r,
  {o.sdiv('2 * hit', 'called + support')} AS f, support FROM cm),
acc AS (SELECT avg(CAST(label = predicted_label AS INTEGER)) AS a FROM test_scored),
report AS (SELECT CASE c WHEN 0 THEN 'negative' ELSE 'positive' END AS scope, p, r, f, support FROM prf
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM prf
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
    sum(f * support) / sum(support), sum(support) FROM prf)"""


@query(
    "classification_metrics",
    f"""WITH {o.LABELED}, {_METRICS} SELECT scope, {o.r6('p')} AS precision, {o.r6('r')} AS recall, {o.r6('f')} AS f1,
    support::BIGINT AS support, (SELECT {o.r6('a')} FROM acc) AS accuracy FROM report""",
)
def classification_metrics(spark, sf):
    return rounded(models.classification_metrics(_test_scored(spark, sf)))


@query(
    "confusion_matrix",
    o.model_sql(
        "SELECT c AS label, count(*) FILTER (label = c AND predicted_label = 0) AS predicted_0, "
        "count(*) FILTER (label = c AND predicted_label = 1) AS predicted_1 "
        "FROM test_scored CROSS JOIN (VALUES (0), (1)) k(c) GROUP BY c"
    ),
)
def confusion_matrix(spark, sf):
    return models.confusion_matrix(_test_scored(spark, sf))


# Largest slope of the objective that counts as its minimum; the penalty's own scale is 1.
_AT_MINIMUM = 0.01


@query(
    "train_logistic_regression",
    o.model_sql(f"SELECT term, {o.r6('idf')} AS idf, true AS at_minimum FROM vocab UNION ALL SELECT NULL, NULL, true"),
)
def train_logistic_regression(spark, sf):
    """The objective is strictly convex, so a model is the fitted one if its gradient vanishes."""
    train = _train(spark, sf)
    vocabulary = durable(models.fit_vocabulary(train))
    vectors = durable(features.document_vectors(train, vocabulary))
    model = durable(models.train_logistic_regression(vectors, vocabulary))
    gradient = models.logistic_regression_gradient(vectors, vocabulary, model)
    return rounded(gradient.select("term", "idf", (F.abs("gradient") < _AT_MINIMUM).alias("at_minimum")))


@query(
    "model_selection",
    f"""WITH {o.LABELED}, {_METRICS}, majority AS (SELECT max(n)::DOUBLE / sum(n) AS share
      FROM (SELECT count(*) AS n FROM split WHERE split = 'test' GROUP BY label))
    SELECT 'naive_bayes' AS model, (SELECT {o.r6('a')} FROM acc) AS accuracy,
      (SELECT {o.r6('f')} FROM report WHERE scope = 'positive') AS f1_positive, true AS sound, 1 AS selected_models
    UNION ALL SELECT 'logistic_regression', NULL, NULL, true, 1""",
)
def model_selection(spark, sf):
    """Naive Bayes exactly; of logistic regression, whose figures SQL cannot give, that it is no worse than
    the majority class; of both, that one is selected and none has a better accuracy."""
    trained = fit_both(fx.labeled_docs(spark, sf))
    rows = durable(trained.selection)
    of_test = durable(trained.test.groupBy("label").agg(F.count(F.lit(1)).alias("n")))
    majority = of_test.agg(F.max("n") / F.sum("n")).scalar()
    best = rows.agg(F.max("accuracy")).scalar()
    bayes = F.col("model") == "naive_bayes"
    no_worse = bayes | (F.col("accuracy") >= majority)
    return rounded(
        rows.select(
            "model", F.when(bayes, F.col("accuracy")).alias("accuracy"), F.when(bayes, F.col("f1_positive")).alias("f1_positive"),
            (no_worse & (~F.col("selected") | (F.col("accuracy") == best))).alias("sound"),
            F.lit(rows.agg(F.count_if("selected")).scalar()).cast("int").alias("selected_models"),
        )
    )
