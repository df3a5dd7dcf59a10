"""Time every registered query at BENCH_SF_DIR on local[BENCH_CPUS]; print one JSON line.

Each query is run to the end with a no-op sink, so nothing is collected. The first, untimed query
warms the session up. ``python bench.py name ...`` times the named ones only.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from periodica.catalog import QUERIES  # noqa: E402
from periodica.session import build_session  # noqa: E402


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(cores, int(cores) if cores.isdigit() else None)
    names = sys.argv[1:] or list(QUERIES)
    run(spark, folder, "limit_ordered")
    timings = {}
    for name in names:
        timings[name] = round(run(spark, folder, name), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
