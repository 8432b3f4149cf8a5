"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to completion without collecting: once to warm up, then timed as the
median of three runs, from building the plan to the last row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from grantsieve.contract.queries import QUERIES
from grantsieve.session import local_session

HEADLINE = (
    "r1_page_records",
    "t1_page_topics",
    "t1_topic_tags",
    "r1_records",
    "e6_due_date",
    "e9_award",
    "h2_solicitation_text",
    "x1_clean_text",
    "d1_keep_first",
    "j1_resolve_jobs",
    "a4_resolve_attempts",
    "l2_catalogue_records",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
