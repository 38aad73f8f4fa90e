"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from reviewloom.session import get_session
from reviewloom.workbook.queries import all_queries

HEADLINE = [
    "top_words_by_lang", "top_words_rating_category", "top_bigrams_by_lang", "top_bigrams_rating_category",
    "word_cloud_weights", "full_analysis", "rating_counts_grid", "split_review_parts", "stop_words_removed", "identical_review_sets",
    "dedup_catalog", "load_catalog_reviews", "quota_selection", "cap_reviews", "adaptive_scope", "integrity_report",
    "flag_update", "surrogate_keys", "page_links", "page_reviews", "csv_roundtrip_multiline",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "reviewloom-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.range(1_000_000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
