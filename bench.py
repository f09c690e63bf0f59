"""Benchmark: every catalogue query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and run once to warm up (JIT, file listing, plan caches),
then timed ``BENCH_RUNS`` times (default 3; once if it took over ``LONG`` seconds) into a ``noop`` sink (the full plan runs, no output is
written); the median is reported.  Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldops.plans.catalog import QUERIES  # noqa: E402
from fieldops.session import local_session  # noqa: E402


LONG = 30


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="fieldops-bench")
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        samples: list[float] = []
        try:
            warm = run_once(spark, QUERIES[name], sf_dir)
            samples = [run_once(spark, QUERIES[name], sf_dir) for _ in range(1 if warm > LONG else runs)]
            times[name] = round(statistics.median(samples), 3)
        except Exception as e:  # noqa: BLE001 - report and continue with the other queries
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"# {name}: {times.get(name, errors.get(name))} samples={samples if name in times else ''}",
              file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_warm_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "runs": runs}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
