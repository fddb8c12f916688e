"""Time the headline queries and print one JSON line.

Every query is written to the noop sink: one warm-up, then the median of three runs
(one timed run for the iterative ones).
"""

import json
import os
import statistics
import sys
import time

from adlode.plans.catalog import QUERIES
from adlode.session import get_session

HEADLINE = (
    "skill_frequency", "clean_listings", "extract_skills", "extract_skills_one_pass",
    "extract_skills_large", "skill_frequency_large", "association_rules_orders", "detect_language", "listing_hash",
    "dedup_listings", "ingest_new_rows", "ingest_summary", "page_cards", "page_fields", "page_links", "page_label_map",
    "language_share", "source_comparison", "top_skills_per_group", "category_breakdown", "skill_frequency_filtered",
    "taxonomy_aliases", "listing_clusters", "group_profiles", "archetype_scores", "itemsets", "itemsets_orders",
    "association_rules", "weekly_trend",
)
ONCE = ("kmeans_clusters", "elbow_k", "stream_dedup", "stream_weekly_trend")


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE + ONCE
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        repeat = 1 if name in ONCE else 3
        if repeat > 1:
            timed(lambda: QUERIES[name](spark, folder))
        seconds[name] = round(statistics.median(timed(lambda: QUERIES[name](spark, folder)) for _ in range(repeat)), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
