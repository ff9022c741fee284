"""Benchmark: headline report queries at one scale factor.

Prints ONE JSON line:
{"metric": "report_suite_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is a registered query (source tables derived from ``events``,
then the report), written in full to a sink that keeps nothing: ``count()``
would let the optimizer drop columns and joins.  After one untimed warm-up of
the whole suite (JVM start, code generation) each query runs three times and
the median counts.  All caches are dropped before every run, so each time
includes deriving and persisting the shared relations.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weekwise import registry  # noqa: E402
from weekwise.session import build_session  # noqa: E402

HEADLINE = [
    "weekly_report_derived",
    "click_report_derived",
    "task_group_clicks_derived",
    "indicator_pivot",
    "click_indicator_pivot",
    "task_group_pivot",
    "trading_retention",
    "deposit_retention",
    "trading_growth",
    "deposit_growth",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    qs = registry.queries()

    def run(name: str) -> float:
        registry.reset()
        spark.catalog.clearCache()
        t = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for name in HEADLINE:  # warm-up
        run(name)
    times = {name: round(statistics.median(run(name) for _ in range(3)), 3) for name in HEADLINE}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "report_suite_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
