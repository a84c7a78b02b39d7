"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion into Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver) and timed wall-clock.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rollup_mean_popularity",
    "rollup_median_popularity",
    "main_features_popularity",
    "genre_count_popularity",
    "named_value_popularity",
    "feature_table",
    "flatten_tracks",
    "clean_collections",
    "quality_report",
    "description_word_count",
    "describe_quartiles",
    "histogram_equal_width",
    "kernel_density",
    "id_batches",
    "corr_label_features",
    "mutual_information_binned",
    "baseline_metrics",
    "rank_predictions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from cadenza.plans.catalog import load_all
    from cadenza.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="cadenza-bench")
    registry = load_all()
    # Warm-up (not timed): open every table once so JVM class loading and JIT
    # are not charged to whichever query happens to run first.
    from cadenza.sources.standins import DRIVER_TABLES

    for t in DRIVER_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(1).collect()
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        df = registry[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
