"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1), BENCH_CPUS: local cores
(default 8), BENCH_RUNS: timed runs after one warm-up (default 3, the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vellum.plans import QUERIES  # noqa: E402
from vellum.session import local_session  # noqa: E402

HEADLINE = [
    "overdue_by_department",
    "reference_match",
    "match_coverage",
    "missing_rollup",
    "reverse_links",
    "upsert_protected",
    "expired_cascade",
    "page_links",
    "nearest_heading",
    "expired_scan",
    "sequence_ids",
    "request_audit",
    "transfer_gate",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}
    for name in names:
        spent = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - start)
        times[name] = round(statistics.median(spent[1:] or spent), 3)
        print(f"{name} {spent}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
