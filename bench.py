"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default all), ``BENCH_RUNS`` (default 2). Each query runs once to warm up,
then ``BENCH_RUNS`` times into the ``noop`` sink; the median counts. Input is read from parquet in every run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from skyops.catalog import QUERIES  # noqa: E402
from skyops.session import local_session  # noqa: E402

HEADLINE = (
    "mart_hourly", "mart_route_daily", "mart_distance_daily", "base_departure_airport_hourly", "airport_lookup",
    "route_detail", "scd2_history", "scd2_events", "scd2_tracked", "scd2_hot_keys", "dedup_latest", "scd1_snapshot",
    "snapshot_diff", "envelope_parse", "quarantine_summary", "rule_metrics", "landing_completeness", "coverage_audit",
    "log_health",
)
# These write tables as they run; once is enough.
ONCE = ("stream_scd2",)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, shuffle_partitions=int(cpus), **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds: dict[str, float] = {}
    spread: dict[str, float] = {}
    for name in HEADLINE + ONCE:
        times = [timed(name) for _ in range(1 if name in ONCE else runs + 1)]
        kept = times if name in ONCE else times[1:]
        seconds[name] = round(statistics.median(kept), 3)
        spread[name] = round(max(kept) - min(kept), 3)
    print(json.dumps({
        "metric": "total_median_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "spread": spread,
        "sf": sf_dir.rsplit("sf", 1)[-1].strip("/"),
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
