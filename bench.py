"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local threads. Each
query is built and run to the end, into a sink that keeps nothing; of those that take under five
seconds, the median of three runs counts. An untimed pass over the
smallest tables beside those, if there are any, loads and compiles what a long-lived session has
ready. Names given as arguments limit the run to those queries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

from aerolith.session import build_session
from workload.queries import registered

HEADLINE = [
    "dedupe_latest", "union_sources", "unit_normalise", "daily_rollup", "batch_daily",
    "air_daily_median", "air_daily_deduped", "pivot_pollutants", "fct_weather", "fct_air",
    "stress_score", "monthly_normals", "rolling_30d", "heat_waves", "heat_waves_calendar",
    "heat_episodes", "rank_exceedance", "top_stress", "corr_rain", "outliers_z",
    "percentile_large_groups", "hourly_payload", "measurement_payload", "month_windows",
    "mart_slice", "stream_sink", "quality_report", "climate_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = registered()
    names = sys.argv[1:] or HEADLINE

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            run(name, small)

    def timed(name: str) -> float:
        first = run(name, sf_dir)
        return first if first > 5 else median([first, run(name, sf_dir), run(name, sf_dir)])

    seconds = {name: timed(name) for name in names}
    spark.stop()
    report = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
