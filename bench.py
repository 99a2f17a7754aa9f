"""Benchmark of the headline queries.

Runs each query once to warm up, then ``BENCH_RUNS`` (default 3) timed runs,
and prints ONE JSON line with the median seconds per query and their sum.
Each run executes the whole plan with the ``noop`` sink (no collect).
The station stand-ins are derived from the driver tables once per
application and stored as Parquet (as a deployment stores its long station
table); the warm-up run writes them, and the timings cover the operators
reading them.  split_sweep, holdout_split and histogram_100 read the written
model table as well; ``model_table_build`` is the time of building it.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS, BENCH_QUERIES (comma list to override the headline set).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stationkit.plans.registry import QUERIES, build_model_table  # noqa: E402
from stationkit.session import local_session  # noqa: E402

#: timed besides registered queries: what split_sweep, holdout_split and
#: histogram_100 find written
EXTRA = {"model_table_build": build_model_table}

HEADLINE = [
    "supervised_table",      # full preparation job, 3 stations
    "supervised_table_three", "supervised_table_many", # the same on the 1,000-series table (3 stations used)
    "interpolate_linear",    # W4, 3 stations
    "interpolate_many",      # W4, one series per supplier
    "future_targets_many",   # W1, one series per supplier
    "corr_matrix",           # A1, 120 column pairs in one pass
    "corr_measures_many",    # A1 over the long table of one series per supplier
    "split_sweep",           # M4, 300 least-squares fits
    "holdout_split",         # O4, exact random split
    "histogram_100",         # A3
    "event_interpolate_skewed",  # W4 with one series holding a third of all rows
    "model_table_build",     # preparation plus global row ids, not read from the stored table
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          app="stationkit-bench", memory="16g")
    times: dict[str, float] = {}
    for n in names:
        fn = EXTRA.get(n) or QUERIES[n]
        fn(spark, sf).write.format("noop").mode("overwrite").save()  # warm-up
        ts = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf).write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        times[n] = round(statistics.median(ts), 3)
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_label, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
