"""Time every query at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tripguard.plans.queries import QUERIES
from tripguard.session import local_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session(cores, "tripguard-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Load classes and warm the code cache outside the timings.
    QUERIES["loaded_years"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds over all queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
