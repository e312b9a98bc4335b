"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall-clock seconds.

Each query is fully executed into Spark's no-op sink (no collect to the
driver).  An untimed warm-up pass runs every job once on the smallest data
folder.  Derived domain tables are written once per application (the load
step), so the first job that needs a table pays for deriving it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:] if not a.startswith("-")]

    from caseflow.plans.catalog import QUERIES
    from caseflow.session import build_session

    spark = build_session(f"local[{cpus}]", max(2 * cpus, 8), "caseflow-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    names = only or list(QUERIES)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # JVM warm-up: compile every job's code paths once on the smallest
    # folder next to the measured one (if present), untimed.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for n in names:
            QUERIES[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        run(names[0])
    times = {}
    for n in names:
        try:
            times[n] = round(run(n), 3)
        except Exception as e:  # noqa: BLE001
            print(f"{n} failed: {e}", file=sys.stderr)
            times[n] = None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    done = [v for v in times.values() if v is not None]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(done), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else None,
                      "cpus": cpus, "failed": [k for k, v in times.items() if v is None]}))
    spark.stop()


if __name__ == "__main__":
    main()
