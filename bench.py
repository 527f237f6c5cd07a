"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local cores. Each
query runs its whole plan into the no-op sink, once to warm up and then
BENCH_REPEATS times, of which the fastest counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from matchledger.registry import all_queries  # noqa: E402
from matchledger.session import local_session  # noqa: E402

HEADLINE = [
    "fct_games",
    "fct_games_dedup",
    "fct_rooms",
    "fct_rooms_dedup",
    "daily_player",
    "daily_player_single_pass",
    "forward_fill",
    "marketing_roas",
    "roas_cumulative",
    "true_streaks",
    "merge_upsert_games",
    "merge_upsert_daily_player",
    "fct_games_incremental_fixed",
    "daily_player_incremental_fixed",
    "dq_sources_not_null",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for attempt in range(repeats + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - start
            if attempt > 0 or repeats == 0:
                best = elapsed if best is None else min(best, elapsed)
        times[name] = round(best, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
