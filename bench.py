"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

from pagetables.plans.catalog import QUERIES
from pagetables.session import build_session

HEADLINE = (
    "extract_articles",
    "page_records",
    "page_paragraphs",
    "page_links",
    "links_distinct",
    "clean_content",
    "read_time",
    "json_ld",
    "recent_events",
    "completeness_filled",
    "summary_lines",
    "missing_samples",
    "keyword_counts",
    "keyword_top_records",
    "fetch_outcome_counts",
    "fetch_latest",
    "crawl_reach",
    "jsonl_roundtrip",
    "stream_articles",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        # Small inputs: let one file feed all cores.
        spark__sql__files__maxPartitionBytes="2m",
        spark__sql__files__openCostInBytes="256k",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # Class loading, code generation and Python workers are started on the smallest tables, outside the measured time.
    smallest = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm_dir = smallest if os.path.isdir(smallest) else sf_dir
    timings = {}
    for name in names:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
