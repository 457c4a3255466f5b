"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` choose data and cores,
``BENCH_RUNS`` the runs after one warm-up, of which the median counts, and ``BENCH_ONLY`` a
comma separated list of queries ("all" for every registered one).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from citeloom.session import session  # noqa: E402
from suite.all_queries import QUERIES  # noqa: E402

HEADLINE = [
    "normalize_documents",
    "document_keyword_reasons",
    "publisher_forms",
    "size_totals",
    "record_scalars",
    "record_descriptions",
    "affiliation_rows",
    "author_lookup",
    "publication_lookup",
    "linked_publications_of_lines",
    "national_signals",
    "keep_first",
    "catalogue",
    "merge_affiliations",
    "resolve_conflicts",
    "url_signatures",
    "match_registry",
    "pending_slices",
    "institution_files",
    "stream_slice_counts",
]


def timed(spark, name: str, sf_dir: str) -> tuple[float, float]:
    """Seconds to build and plan the query (jobs that write tables on the way included), and to run it."""
    begin = time.perf_counter()
    result = QUERIES[name](spark, sf_dir)
    result._jdf.queryExecution().executedPlan()
    planned = time.perf_counter()
    result.write.format("noop").mode("overwrite").save()
    return planned - begin, time.perf_counter() - planned


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = os.environ.get("BENCH_ONLY", "")
    names = list(QUERIES) if only == "all" else only.split(",") if only else HEADLINE
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.log.level": "ERROR",
        },
    )
    seconds, plan_seconds = {}, {}
    for name in names:
        timed(spark, name, sf_dir)
        times = [timed(spark, name, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(sum(t) for t in times), 3)
        plan_seconds[name] = round(statistics.median(t[0] for t in times), 3)
        print(name, seconds[name], "of which planning", plan_seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "plan_seconds": plan_seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
