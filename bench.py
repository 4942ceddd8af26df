"""Time the headline queries on BENCH_SF_DIR with local[BENCH_CPUS]; one JSON line on stdout."""

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from postlens.plans.catalog import QUERIES  # noqa: E402
from postlens.session import local_session  # noqa: E402

HEADLINE = [
    "hourly_nss",
    "realtime_kpis",
    "aspect_summary",
    "cross_platform",
    "rollup_15min",
    "rolling_baseline",
    "ingestion_health",
    "viral_negative_posts",
    "cusum_lower",
    "crisis_alerts",
    "reply_edges",
    "pagerank",
    "communities",
    "clean_documents",
    "spam_grade",
    "tfidf_weights",
    "ctfidf_keywords",
    "upsert_posts",
    "insert_ignore_posts",
    "explode_aspects",
    "check_deliveries",
    "text_length_stats",
    "stream_windows",
    "daily_report",
    "language_detection",
    "nmf_topics",
    "embedding_topics",
    "score_documents",
    "evaluate_heads",
    "enrich_stream",
]
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def seconds(spark, name, sf_dir):
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "postlens-bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    timings = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        timings[name] = round(
            statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of warm medians",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
