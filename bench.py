"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line. Every query is forced to
full execution with the ``noop`` sink (no driver collect); each is run once
to warm up and then timed as the median of ``$BENCH_REPS`` (default 3) runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shortbook.plans import registry  # noqa: E402
from shortbook.session import get_spark  # noqa: E402

HEADLINE = [
    "count_source",
    "top_short_borrow",
    "ticker_history",
    "availability_changes",
    "zscore",
    "pct_rank",
    "diff",
    "log_returns",
    "change_history",
    "dedupe_keep_last",
    "asof_join",
    "time_split_train",
    "filings_enriched",
    "quality_by_file",
    "zscore_hot_ticker",
    "asof_hot_ticker",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = get_spark(f"local[{cpus}]", app="shortbook-bench", shuffle_partitions=int(cpus),
                      extra={"spark.driver.memory": "8g"})
    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = registry.QUERIES[name]

        def run():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up
        times[name] = round(statistics.median(run() for _ in range(reps)), 4)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
