"""Bench: run every catalog query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``
and print one JSON line with per-query wall seconds.

Each query is fully executed with a no-op sink (``write.format("noop")``),
so timings include the whole plan but no driver collect.  One warm-up pass
over a small query loads the JVM and Parquet readers first.  Each query
runs ``$BENCH_REPEAT`` times (default 2).  ``queries`` holds the fastest run of
each (single runs of many small stages vary by +-20 % on a shared machine);
``first`` (with compilation) and ``median`` are reported beside it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starbuild.plans import catalog  # noqa: E402
from starbuild.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="starbuild-bench")
    catalog.QUERIES["staging_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    first: dict[str, float] = {}
    middle: dict[str, float] = {}
    errors: dict[str, str] = {}
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    for key, fn in catalog.QUERIES.items():
        if only and key not in only:
            continue
        runs = []
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[key] = round(min(runs), 3)
            first[key], middle[key] = round(runs[0], 3), round(statistics.median(runs), 3)
        except Exception as e:  # noqa: BLE001 - report and keep benchmarking
            errors[key] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir).removeprefix("sf")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "repeat": repeat,
           "first_total": round(sum(first.values()), 3), "median_total": round(sum(middle.values()), 3),
           "first": first, "median": middle}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
