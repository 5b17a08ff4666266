"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is evaluated in
full through the ``noop`` sink, so no result passes through the driver.

Session setup (SQL function definitions, JVM and Python worker start-up, JIT
warm-up) is a fixed cost per session, not per query: each headline query is
first run once on the tiny sf0.001 tables, and that time is reported
separately as ``warmup_sec``; the timed runs then measure steady-state work
at the benchmark scale.  Set ``BENCH_WARMUP=0`` to time cold runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from webloom.functions.urls import register_functions  # noqa: E402
from webloom.plans import catalog  # noqa: E402
from webloom.session import build_session  # noqa: E402

HEADLINE = [
    "html_to_markdown",       # flagship: one parse per page + Markdown layout
    "content_text",           # content areas / unwanted subtrees (F2)
    "internal_links",         # parse -> posexplode -> resolve -> normalise -> distinct
    "external_links",
    "markdown_records",       # Markdown round trip + line trimming
    "trim_repeated_lines",    # documents: array functions on each row's lines
    "first_successful_attempt",
    "exclude_robots",
    "politeness_schedule",    # distributed prefix scan over events
    "crawl_many",             # level-synchronous BFS with checkpoints
    "name_collisions",
    "match_variants",
    "site_crawl",             # end to end on the pages' own hosts: parse once, link graph, BFS to depth 5
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    # session setup: define the SQL functions, start the JVM and Python workers
    t0 = time.perf_counter()
    register_functions(spark)
    warm = names if os.environ.get("BENCH_WARMUP", "1") != "0" else ["html_to_markdown"]
    for name in warm:
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    warmup = round(time.perf_counter() - t0, 3)
    times = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    label = os.path.basename(sf.rstrip("/"))
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": label.replace("sf", ""), "warmup_sec": warmup,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
