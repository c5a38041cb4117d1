"""Benchmark the headline queries.

Runs every query registered with ``bench=True`` plus the flagship chain at
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``:
one warm-up run, then the median of ``$BENCH_RUNS`` (default 3) full
materialisations (``write.format("noop")``).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from parcelkit.plans.catalog import BENCH, QUERIES
    from parcelkit.session import get_session

    spark = get_session(cpus=cpus, shuffle_partitions=int(cpus) if cpus != "*" else 8)
    names = only or (list(BENCH) + ["flagship"])
    times: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()  # warm-up (JIT, file listing, broadcast of small sides)
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf_val = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_val, "cpus": cpus, "runs": runs,
                      "spark": spark.version}))


if __name__ == "__main__":
    main()
