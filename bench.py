"""Time every registered query once, after one warm-up, and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wayfold.plans.queries import QUERIES  # noqa: E402
from wayfold.session import local_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    # A few megabytes must still occupy all cores, because labelling is bound by them.
    spark = local_session(cpus, "bench", **{"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"})
    QUERIES["labelled_points"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
