"""Benchmark: run every registered query on $BENCH_SF_DIR and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row is computed,
nothing is collected to the driver).  Environment:
  BENCH_SF_DIR  input tables (default /root/testdata/sf0.1)
  BENCH_CPUS    local threads (default 8)
  BENCH_ONLY    optional comma-separated query names
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    from marginalia.session import get_spark
    from marginalia.plans import QUERIES

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    # warm the JVM and the parquet footer cache once
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        try:
            q.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and go on
            failed[name] = str(e)[:200]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
