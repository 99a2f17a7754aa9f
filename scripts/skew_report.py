"""Per-task row counts of the skewed event-series interpolation, read from
Spark's event log: the one-task-per-series strategy versus the chunked one.

Usage: python scripts/skew_report.py <sf_dir> <scratch_dir>
Prints, per strategy, the largest and median shuffle records read by one
task in the stages that read shuffled rows.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from stationkit.operators.impute import interpolate_linear  # noqa: E402
from stationkit.operators.series_window import Ordering  # noqa: E402
from stationkit.sources.fixtures import event_series  # noqa: E402


def main():
    sf, scratch = sys.argv[1], sys.argv[2]
    logdir = os.path.join(scratch, "eventlog")
    os.makedirs(logdir, exist_ok=True)
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ev = event_series(spark, sf)
    hot = ev.where("series_id = 'hot'").count()
    total = ev.count()
    runs = {
        "one task per series": Ordering(("series_id",), ("ts", "event_id"), mode="series"),
        "chunked (auto, 5000-row budget)": Ordering(("series_id",), ("ts", "event_id"),
                                                    max_rows_per_task=5000),
    }
    for label, o in runs.items():
        spark.sparkContext.setJobGroup(label, label)
        interpolate_linear(ev, ["value"], o).write.format("noop").mode("overwrite").save()
    spark.stop()
    # job group -> stage ids, then per-stage task shuffle reads
    group_of_stage, reads = {}, {}
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    grp = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for s in e.get("Stage IDs", []):
                        group_of_stage[s] = grp
                elif e["Event"] == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    if r:
                        reads.setdefault(e["Stage ID"], []).append(r)
    print(f"rows: {total}, hot series: {hot} ({hot / total:.0%})")
    for label in runs:
        tasks = [r for s, rs in reads.items() if group_of_stage.get(s) == label for r in rs]
        big = max(tasks) if tasks else 0
        print(f"{label:34s} shuffle-reading tasks: {len(tasks):4d}  largest task: {big:7d} rows  "
              f"median: {statistics.median(tasks) if tasks else 0:7.0f} rows")


if __name__ == "__main__":
    main()
