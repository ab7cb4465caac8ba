"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list to restrict), ``BENCH_WARMUP``
(default 1).  Each query is run to completion with the ``noop`` sink (full
execution, no collection to Python).  With warm-up on, every query first runs
once on the sf0.001 tables so JVM JIT and Spark code generation are not
billed to the timed run; the cold times are reported under ``cold``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "e1_lap_features",          # flagship: raw samples -> grid -> dynamics -> lap features
    "c1_resample_zoh",
    "c2_interpolate_distance",
    "c7_c8_enrich",
    "c9_time_from_speed",
    "d5_ghost_delta_all",
    "e7_box_stats",
    "d3_telemetry_of_fastest",
    "c11_fastest_laps",
    "a7_pending_sessions",
    "f7_matrix_norm",
    "f3_f4_pca_scores",
    "f16_cv_least_squares",
    "f16_cv_lasso",
    "st1_stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    from lapengine.plans import registry
    from lapengine.session import build_session
    registry.load_all()
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    cold = {}
    if os.environ.get("BENCH_WARMUP", "1") == "1" and os.path.isdir(warm):
        for n in names:
            t0 = time.perf_counter()
            registry.QUERIES[n](spark, warm).write.format("noop").mode("overwrite").save()
            cold[n] = round(time.perf_counter() - t0, 3)
    times = {}
    for n in names:
        t0 = time.perf_counter()
        registry.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "warmup_sf0.001": cold}))
    spark.stop()


if __name__ == "__main__":
    main()
