"""Time the headline queries; prints one JSON line.

Every query runs over its whole tables and its result is written to the no-op
sink, so all columns of all rows are computed. After a warm-up each is timed
``$BENCH_RUNS`` times (2 by default) and the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedmill.catalogue import QUERIES  # noqa: E402
from feedmill.session import local_session  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def seconds(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    times = {}
    for name in names:
        query = QUERIES[name]
        seconds(query.build(spark, sf_dir))
        runs = [seconds(query.build(spark, sf_dir)) for _ in range(RUNS)]
        times[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
