"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores;
arguments, if any, choose queries. Each query runs once after a warm-up of the session and is
drained into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from moodtide.catalog.queries import QUERIES
from moodtide.session import SCAN_PARTITIONS

HEADLINE = (
    "scan_jsonl", "scan_zst", "scan_csv_with_header", "reject_reason_waterfall", "standardize_record",
    "ingest_counters", "dedup_by_id", "sort_by_time", "build_final_text", "clean_text", "matched_keywords",
    "topic_coverage", "overall_summary", "period_sentiment_table", "group_sentiment_table",
    "monthly_sentiment_table", "topic_sentiment_table", "topic_sentiment_summary", "topic_monthly_table",
    "topic_post_long", "topic_monthly_trends_long", "trend_pivot_counts", "topic_group_monthly_trends",
    "semi_join_eligible_authors", "user_topic_sentiment_long", "h1_proportion_test", "h2_sentiment_tests",
    "h3_topic_correlation_matrix", "h4_correlation", "hypothesis_readiness", "document_frequency",
    "vocabulary_topn", "tfidf_weights", "stratified_split", "train_naive_bayes", "train_logistic_regression",
    "predict_sentiment", "classification_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("moodtide-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config(SCAN_PARTITIONS, cpus)  # the documents are one row group, hence one split
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run("group_sentiment_table")
    seconds = {}
    for name in names:
        seconds[name] = round(run(name), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
