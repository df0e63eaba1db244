"""Store throughput on a grid of its own: build and audit, GiB of logical float32 per second.

    python throughput.py [steps] [rows] [columns]
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from gridcube.config import GridConfig  # noqa: E402
from gridcube.cube import Cube  # noqa: E402
from gridcube.plans.build import build_store  # noqa: E402
from gridcube.plans.verify import Audit  # noqa: E402
from gridcube.session import tune  # noqa: E402


def config_of(root: str, layout: str, steps: int) -> GridConfig:
    spatial = layout == "spatial"
    return GridConfig({
        "directories": {"download": root}, "dataset": "made", "version": "v1.0a", "variables": "all",
        "output_conventions": {"filename": "{suffix}/{variable}", "suffix": layout}, "temporal_resolution": "daily",
        "chunks": {"time": 1, "lat": -1, "lon": -1} if spatial else {"time": -1, "lat": 20, "lon": 20},
        "write_strategy": "append" if spatial else "region", "timesteps_per_commit": max(1, steps // 2),
        "attrs": {},
    }).of("E")


def main() -> None:
    steps, n_lat, n_lon = (int(v) for v in (sys.argv[1:] or ("100", "400", "800")))
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = tune(
        SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "32").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    config = config_of(root, "spatial", steps)
    plane = n_lat * n_lon
    cells = spark.range(0, steps * plane, 1, 32).select(
        F.expr(f"cast(id div {plane} as int)").alias("t"), F.expr(f"cast(id div {n_lon} % {n_lat} as int)").alias("i"),
        F.expr(f"cast(id % {n_lon} as int)").alias("j"),
    )
    noise = (F.pmod(F.xxhash64("t", "i", "j"), F.lit(1000)) / 250 + F.sin(F.col("t") / 58) + F.cos(F.col("i") / 40)).cast("float")
    land = F.sin(F.col("i") / 23) + F.cos(F.col("j") / 31) > 0.3
    rows = cells.select(
        F.col("t").alias("local_t"), (F.col("t") + 29219).cast("long").alias("days"), "i", "j",
        (89.95 - F.col("i") * 0.1).alias("lat"), (-179.95 + F.col("j") * 0.1).alias("lon"),
        F.when(land, noise).otherwise(F.lit(-999.0).cast("float")).alias("value"),
    )
    rows.write.parquet(f"{config.raw_dir}/E/E_1980.parquet")
    Path(f"{config.raw_dir}/E/_attrs.json").write_text(json.dumps({"variable": {"units": "mm.day-1"}, "global": {}}))
    gib = steps * plane * 4 / 2**30
    out = {"cells": steps * plane, "gib": round(gib, 3)}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        seconds = time.perf_counter() - start
        out[f"{name}_sec"], out[f"{name}_gib_per_sec"] = round(seconds, 2), round(gib / seconds, 4)
        return result

    for layout in ("spatial", "temporal"):
        own = config_of(root, layout, steps)
        timed(f"build_{layout}", lambda: build_store(spark, own))
        audit = Audit(spark, own, samples=20)
        timed(f"audit_{layout}", audit.run)
        out[f"audit_{layout}_failures"] = len(audit.failures)
        cube = Cube.open(spark, own, ["E"])
        timed(f"daily_mean_{layout}", lambda: cube.land_mean(["date"]).write.format("noop").mode("overwrite").save())
        start = time.perf_counter()
        cube.isel(i=(100, 101), j=(100, 101)).cells().count()
        out[f"series_{layout}_sec"] = round(time.perf_counter() - start, 2)
        start = time.perf_counter()
        cube.isel(t=(5, 6)).cells().count()
        out[f"map_{layout}_sec"] = round(time.perf_counter() - start, 2)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
