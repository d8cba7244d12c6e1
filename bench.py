"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) apply.
Each query is built and run to completion (all columns computed, rows discarded);
the best of two runs counts, so that JVM warm-up is left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks import catalog
from checks.run import session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
HEADLINE = (
    "monthly_region_net_revenue",
    "monthly_pnl",
    "weekly_region_net_revenue",
    "weekly_pnl",
    "conditional_count_distinct",
    "commerce_by_segment",
    "division_scorecard",
    "promo_funding_all_dates",
    "interval_join",
    "on_time_delivery",
    "nps_by_region",
    "acquisition_cost",
    "labor_period_rollup",
    "scorecard_report",
)


def main() -> None:
    spark = session()
    queries = catalog.queries()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
