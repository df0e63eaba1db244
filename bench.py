"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from gridcube.catalog.all import REGISTRY  # noqa: E402
from gridcube.session import tune  # noqa: E402

HEADLINE = (
    "land_mean", "land_mean_daily", "time_mean_cell", "annual_resample", "percentiles", "robust_limits",
    "season_difference", "merge_exact", "component_shares", "identity_residual", "compare_with_raw",
    "tile_valid_counts", "chunk_manifest", "size_stats", "sibling_absent", "smallest_chunks",
    "locate_timestep", "axis_first_difference", "rechunk_tiles", "ancestry_depth",
    "append_store", "region_store", "cube_series", "stream_append",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    spark.read.parquet(f"{folder}/events.parquet").write.format("noop").mode("overwrite").save()  # JVM warm-up
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
