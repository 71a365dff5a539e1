"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per query
(median reported, after one warm-up). The derived plant tables and raw documents are written to
parquet and text before timing, so the times are those of the operators.
"""

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

HEADLINE = [
    "lkv_ties",
    "lkv_one",
    "i3x_values",
    "station_series",
    "oee_station",
    "oee_line",
    "oee_by_shift",
    "shift_assign",
    "shift_window_join",
    "counter_delta_safe",
    "state_durations",
    "cycle_median",
    "anomaly_zscore",
    "throughput_trend",
    "fault_alerts",
    "asset_list",
    "uns_graph",
    "product_trace",
    "carbon_footprint",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from plantlake.operators.expand import expand_metadata, expand_telemetry
    from plantlake.plans import load
    from plantlake.plans.fixtures import Plant
    from plantlake.plans.messages import batched_messages, metadata_messages, single_messages
    from plantlake.plans.registry import BODIES
    from plantlake.session import scratch

    load()
    derived, stored = Plant(spark, folder), scratch(spark, "tables")
    derived.store(stored)
    raw, meta = scratch(spark, "raw"), scratch(spark, "meta")
    single_messages(derived).unionByName(batched_messages(derived)).write.text(raw)
    metadata_messages(derived).write.text(meta)

    def text(path):
        return spark.read.text(path).withColumnRenamed("value", "payload")

    plant = Plant(spark, folder, stored)
    jobs = {name: (lambda fn: lambda: fn(plant))(BODIES[name]) for name in HEADLINE}
    jobs["telemetry_expand"] = lambda: expand_telemetry(text(raw))
    jobs["metadata_expand"] = lambda: expand_metadata(text(meta))

    only = sys.argv[1:]
    seconds = {}
    for name, job in jobs.items():
        if only and name not in only:
            continue
        times = []
        for _ in range(runs + 1):
            started = time.time()
            job().write.format("noop").mode("overwrite").save()
            times.append(time.time() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
