"""Benchmark the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
The stand-in feeds are stored before the first query; their time and shuffle are in no figure.
Each query: one warm-up, then the median of BENCH_RUNS runs; a run builds the plan and
executes it fully into the no-op sink (every row computed, nothing collected). Shuffle
bytes per run come from Spark's event log, written to a fresh scratch folder.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "user_movement",            # Q1
    "repurchase_median",        # Q2
    "spend_quartiles",          # Q3
    "grid_population",          # Q4
    "female_population",        # Q5
    "grid_population_bounded",  # Q6
    "register_cells",           # Q7
    "cctv_per_cell",            # Q8
    "new_months",               # Q9
    "female_population_csv",    # Q5 from text
    "load_month",               # month load
    "intake_stream",            # the same as a stream
    "grid_intake",              # Q6 + Q7 + month load
]


def shuffle_bytes_by_group(log_dir: str) -> dict[str, int]:
    """Sum of shuffle bytes written by the tasks of each job group, from the event log."""
    stage_group: dict[int, str] = {}
    per_stage: dict[int, int] = defaultdict(int)
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in files:
        with open(path, errors="replace") as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    metrics = ev.get("Task Metrics") or {}
                    written = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    per_stage[ev.get("Stage ID")] += written
    out: dict[str, int] = defaultdict(int)
    for sid, b in per_stage.items():
        if sid in stage_group:
            out[stage_group[sid]] += b
    return dict(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from footfall.catalog import QUERIES, _bounded_pop, _pcel_grid, _sex_age, _time_pop
    from footfall.session import local_session

    log_dir = tempfile.mkdtemp(prefix="run-bench-events-", dir="/tmp")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
                                 "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    times: dict[str, float] = {}
    sc.setJobGroup("fixtures", "fixtures")
    for build in (_time_pop, _sex_age, _bounded_pop, _pcel_grid):
        build(spark, sf_dir)
    for name in names:
        sc.setJobGroup(name, name)
        fn = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
        times[name] = round(statistics.median(samples), 3)

    spark.stop()

    try:
        shuffled = shuffle_bytes_by_group(log_dir)
    except (OSError, ValueError):  # the timing result stands without the shuffle figures
        shuffled = {}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "shuffle_bytes_per_run": {k: shuffled.get(k, 0) // (runs + 1) for k in names},
    }))


if __name__ == "__main__":
    main()
