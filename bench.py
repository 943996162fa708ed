"""Time the headline queries: BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

QUERIES = ["normalize_highlight", "title_key", "classify_3tier", "resolve_bank", "extract_kv_fields", "extract_change", "score_items", "review_flags", "multi_topic_signals", "segment_topics",
           "merge_by_title_key", "dedup_url_first", "title_similarity_pairs", "near_dup_merge", "enrich_from_scores", "category_counts", "advice_lists", "topk_per_group", "archive_manifest",
           "html_pages_to_text", "html_links", "tokenize_mixed", "chunk_text", "bm25_search", "vector_topk", "rrf_fuse", "normalize_items", "stream_weekly_counts"]


def main():
    from pyspark.sql import SparkSession

    from broadsheet.plans import catalog
    from broadsheet.plans.catalog import base
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(QUERIES)).split(",") if n]
    spark = (SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = catalog.load()
    times = {}
    t = time.time()
    base.notices(spark, sf).count()
    times["stage_notices"] = round(time.time() - t, 3)
    for n in names:
        t = time.time()
        try:
            queries[n](spark, sf).write.format("noop").mode("overwrite").save()
            times[n] = round(time.time() - t, 3)
            print(f"\n{n} {times[n]}", file=sys.stderr, flush=True)
        except Exception as e:  # a failed query must not hide the others
            times[n] = None
            print(f"{n}: {type(e).__name__}", file=sys.stderr)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(v for v in times.values() if v), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
