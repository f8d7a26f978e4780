"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints ONE JSON line:

  {"metric": "headline_total_sec", "value": <cold end-to-end seconds>,
   "unit": "sec", "queries": {name: warm median seconds}, "sf": ..., ...}

* cold: every headline query once, in order, from the parquet files,
  including the shared stage tables (cleaned catalogue, deduplicated
  ratings) that the first query builds;
* warm: each query again, 3 times, median (stage tables already written).

Every result is fully computed (``noop`` sink), not sampled or limited.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ranklight.plans import registry  # noqa: E402
from ranklight.session import get_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", "ranklight-bench", shuffle_partitions=max(8, cpus * 2))
    registry.load_all()
    names = list(registry.HEADLINE)
    t0 = time.time()
    cold = {}
    for n in names:
        t = time.time()
        run(registry.QUERIES[n](spark, sf_dir))
        cold[n] = round(time.time() - t, 3)
    total = round(time.time() - t0, 3)
    warm = {}
    for n in names:
        times = []
        for _ in range(3):
            t = time.time()
            run(registry.QUERIES[n](spark, sf_dir))
            times.append(time.time() - t)
        warm[n] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": warm,
                      "cold": cold, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
