"""Posts derived from the given tables, and the study the registered queries run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.config import Period, Study, Topic
from moodtide.operators.measures import measured
from moodtide.operators.posts import build_final_text, keep_with_cleaned_text, with_cleaned_text
from moodtide.operators.tagging import add_time_columns, add_topic_columns, label_to_sentiment
from moodtide.session import prepare_session, qualified, scratch_path, spread
from moodtide.sources.files import arrow_file_system

STUDY = Study(
    groups=tuple(f"src{i}" for i in range(12)),
    year_min=1996,
    year_max=2000,
    periods=(Period("early", 1995, 1996), Period("mid", 1997, 1998), Period("late", 1999, None)),
    topics=(
        Topic("alpha", "Topic alpha", ("ai", "license", "from the")),
        Topic("beta", "Topic beta", ("with", "this")),
        Topic("gamma", "Topic gamma", ("tion", "re")),
        Topic("none", "Topic none", ("zzzz",)),
    ),
    before_period="early",
    after_period="late",
    recruiting_topic="beta",
    layoffs_topic="alpha",
    ai_topic="gamma",
)

# Lines that are not clean records; the group and year limits above apply to them too.
DIRTY_LINES = (
    "",
    "   ",
    "bad{",
    "[1]",
    '{"id": "d1", "title": null, "subreddit": "src1", "created_utc": 852076800}',
    '{"id": "d2", "title": "no group", "created_utc": 852076800}',
    '{"id": "d3", "body": "shout", "subreddit": "  SRC2 ", "created_utc": "852076800"}',
    '{"id": "d4", "subreddit": "src3", "created_utc": "abc", "body": "x"}',
    '{"id": "d5", "subreddit": "src3", "created_utc": null, "body": "x"}',
    '{"id": "d6", "subreddit": "src3", "created_utc": "8.6e8", "body": "x"}',
    '{"id": "d7", "subreddit": "src3", "created_utc": 820454399, "body": "last of 1995"}',
    '{"id": "d8", "subreddit": "src3", "created_utc": 820454400, "body": "first of 1996"}',
    '{"id": "d9", "subreddit": "src3", "created_utc": 978307199, "body": "last of 2000"}',
    '{"id": "d10", "subreddit": "src3", "created_utc": 978307200, "body": "first of 2001"}',
    '{"id": "d11", "subreddit": "elsewhere", "created_utc": 852076800, "num_comments": 3}',
    '{"id": "d12", "subreddit": "src4", "created_utc": 852076800, "score": 5}',
    '{"id": "d13", "subreddit": "", "created_utc": 852076800}',
    '{"id": "d14", "subreddit": "src5", "created_utc": 852076800} trailing',
    '{"id": "d15", "subreddit": "src5", "created_utc": 852076800}{"id": "d16", "subreddit": "src5", "created_utc": 852076800}',
    '{"a": 1},{"b": 2}',
)

# Text fragments on which naive cleaning goes wrong; one is appended to each document.
ADVERSARIAL = (
    "@éabc hi",
    "a b",
    "HTTP://X.y z http",
    "x\x1cy z",
    "@a_b1 c@d.e",
    "http foo",
    "İstanbul @http://u.v w",
    "p http://only.example/x?y=1",
    "@@ab 12 @ cd",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns of the documents."""
    return spread(table(spark, sf_dir, "documents").select(*columns))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document side of a post: key, group, title and body."""
    docs = texts(spark, sf_dir, "doc_id", "source", "text")
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return docs.select(
        "doc_id", F.col("source").alias("subreddit"), title.alias("title"),
        F.substring("text", F.length(title) + 2, F.length("text")).alias("body"),
    )


def final_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, id, subreddit, final_text) of the posts that have any text: title and body, normalised."""
    docs = documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"), "subreddit", F.lit("").alias("author"),
        F.lit(0.0).alias("created_utc"), "title", "body",
    )
    final = build_final_text(docs).select("id", "subreddit", "final_text")
    return final.withColumn("doc_id", F.col("id").cast("bigint"))


def _authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    number = F.col("o_custkey") % 97
    author = F.when(number == 0, F.lit("[deleted]")).otherwise(F.concat(F.lit("user_"), number.cast("string")))
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    return orders.select(F.col("o_orderkey").alias("doc_id"), author.alias("author"), seconds.alias("created_utc"))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("predicted_label"))


def with_people(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """Attach author, time and label; unique keys on every side, so no join can be skewed."""
    joined = docs.join(_authors(spark, sf_dir), "doc_id").join(_labels(spark, sf_dir), "doc_id", "left")
    return joined.withColumn("id", F.col("doc_id").cast("string"))


POST_COLUMNS = ("id", "subreddit", "author", "created_utc", "title", "body", "predicted_label")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_people(spark, sf_dir, documents(spark, sf_dir)).select("doc_id", *POST_COLUMNS)


def _pick(options: list[Column | str | None]) -> Column:
    """The option numbered by doc_id, cycling."""
    n = len(options)
    chain = None
    for i, option in enumerate(options):
        value = option if isinstance(option, Column) else F.lit(option).cast("string")
        place = F.col("doc_id") % n == i
        chain = F.when(place, value) if chain is None else chain.when(place, value)
    return chain


def dirty_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All posts, with placeholder, padded and empty values spread over the fields."""
    title, body, author = F.col("title"), F.col("body"), F.col("author")
    return posts(spark, sf_dir).select(
        "doc_id", "id",
        F.concat(F.lit(" "), F.upper("subreddit"), F.lit("\t")).alias("subreddit"),
        _pick(["AutoModerator", "None", " [Deleted] ", author, F.upper(author), author, None]).alias("author"),
        "created_utc",
        _pick([" [Removed] ", "", title, F.concat(F.lit(" "), title, F.lit(" \n x")), title]).alias("title"),
        _pick(["NULL", "", "nan ", body, body, body, body]).alias("body"),
        "predicted_label",
    )


def post_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as JSON lines, every third one a comment, and the dirty lines."""
    comment = F.to_json(F.struct("id", "subreddit", "author", "created_utc", "body", F.lit(1).alias("score")))
    submission = F.to_json(
        F.struct(
            "id", "subreddit", "author", F.col("created_utc").cast("string").alias("created_utc"), "title",
            F.col("body").alias("selftext"), F.lit(2).alias("score"),
            (F.col("doc_id") % 50).alias("num_comments"), F.concat(F.lit("/r/"), "id").alias("permalink"),
            F.lit(" http://x ").alias("url"),
        )
    )
    lines = posts(spark, sf_dir).select(F.when(F.col("doc_id") % 3 == 0, comment).otherwise(submission).alias("value"))
    dirty = spark.createDataFrame([(line,) for line in DIRTY_LINES], "value string")
    return lines.unionByName(dirty)


def adversarial_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "doc_id", "text").select(
        "doc_id", F.concat(F.col("text"), F.lit(" "), _pick(list(ADVERSARIAL))).alias("text")
    )


def _probabilities() -> list[Column]:
    positive = F.when(F.col("doc_id") % 5 != 0, (F.col("doc_id") * 37 % 101) / 100.0)
    return [(1.0 - positive).alias("prob_negative"), positive.alias("prob_positive")]


def tagged(spark: SparkSession, sf_dir: str, for_filter: bool = False) -> DataFrame:
    """Topic-tagged posts. Title and body are joined, cleaned and searched on the document side, before the
    joins, so no text is ever shuffled."""
    cleaned = keep_with_cleaned_text(final_texts(spark, sf_dir), "final_text")
    flagged = add_topic_columns(cleaned, STUDY, for_filter=for_filter).drop("id", "final_text", "cleaned_text")
    people = add_time_columns(with_people(spark, sf_dir, flagged), STUDY)
    return people.select("*", label_to_sentiment().alias("predicted_sentiment"), *_probabilities())


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(tagged(spark, sf_dir), STUDY)


def cleaned_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, id, cleaned_text) of whole documents."""
    docs = texts(spark, sf_dir, "doc_id", "text").withColumn("id", F.col("doc_id").cast("string"))
    return with_cleaned_text(docs, "text").drop("text")


def labeled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned documents that carry a label: the classifiers' training data."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = texts(spark, sf_dir, "doc_id", "text").withColumn("id", F.col("doc_id").cast("string"))
    labeled = docs.join(labels.filter(F.col("label").isNotNull()), "doc_id")
    return keep_with_cleaned_text(labeled, "text").select("id", "label", "cleaned_text")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double columns rounded, as sums of doubles depend on their order."""
    return df.select(*[F.round(n, digits).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


def write_zst_lines(lines: DataFrame, path: str, window_log: int = 28, frame_bytes: int | None = None) -> None:
    """Write ``value`` as long-window ``.zst`` files, one per task; with ``frame_bytes``, in frames of that many
    bytes of text, which end in the middle of lines."""

    target = qualified(lines.sparkSession, path)

    def write(batches):
        import uuid

        import pyarrow as pa
        import zstandard

        filesystem, root = arrow_file_system(target)
        filesystem.create_dir(root, recursive=True)
        name = f"{root}/part-{uuid.uuid4().hex}.jsonl.zst"
        parameters = zstandard.ZstdCompressionParameters.from_level(3, window_log=window_log)
        compressor = zstandard.ZstdCompressor(compression_params=parameters)
        count, room = 0, frame_bytes
        with filesystem.open_output_stream(name, compression=None) as raw, compressor.stream_writer(raw, closefd=False) as out:
            for batch in batches:
                for value in batch.column(0).to_pylist():
                    line = value.encode("utf-8") + b"\n"
                    while room is not None and len(line) >= room:
                        out.write(line[:room])
                        out.flush(zstandard.FLUSH_FRAME)
                        line, room = line[room:], frame_bytes
                    out.write(line)
                    room = None if room is None else room - len(line)
                    count += 1
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["lines"])

    lines.select("value").mapInArrow(write, "lines bigint").agg(F.sum("lines")).collect()


def fresh(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label)
