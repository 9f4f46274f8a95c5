"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line.
Every query is executed end to end (``noop`` sink, nothing collected).  An
untimed warm-up runs each query once on the smallest test scale (JVM start,
JIT and generated-code compilation), so the timings are steady state.
Per-query time is the best of ``$BENCH_REPEAT`` runs (default 3).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aerocorr.config import local_session  # noqa: E402
from aerocorr.plans import catalog  # noqa: E402

HEADLINE = [
    "remoteness_corr",
    "settlement_corr",
    "min_distance_to_site",
    "nearest_city_ties",
    "nearest_city_within",
    "union_families",
    "daytime_readings",
    "geocode_enrich_keep",
    "geocode_parse",
    "exact_sample",
    "ml_corr_matrix",
    "dedupe_by_key",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session(cpus)
    qs = catalog.queries()
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in only:  # warm-up, untimed
        run(qs[name](spark, warm_dir))
    times = {}
    for name in only:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(qs[name](spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
