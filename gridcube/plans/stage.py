"""Copying a window of some raw files into a small tree of the same shape."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gridcube.config import GridConfig
from gridcube.fs import SharedFs
from gridcube.sources.raw import ATTRS_FILE, RawVariable


def stage_window(
    spark: SparkSession, source: GridConfig, target: GridConfig, variables: list[str],
    i: tuple[int, int], j: tuple[int, int], years: list[int] | None = None, restage: bool = False,
) -> int:
    """Copy a window of each file, sentinel and attributes intact. Returns the files written.

    Files already there are left alone unless ``restage``. Row and column numbers
    restart at 0; their labels do not change.
    """
    if source.raw_dir == target.raw_dir:
        raise ValueError("a window must not be staged over its own source")
    written = 0
    for name in variables:
        raw = RawVariable(spark, source, name)
        fs = SharedFs(spark, target.raw_dir)
        folder = f"{target.raw_dir}/{name}"
        for path in raw.files:
            stem = path.rsplit("/", 1)[1].rsplit(".", 1)[0]
            if years is not None and not any(f"_{y}" in stem for y in years):
                continue
            out = f"{folder}/{stem}.parquet"
            done = fs.exists(f"{out}/_SUCCESS")
            if done and not restage:
                continue
            window = raw._scan([path]).where(
                (F.col("i") >= i[0]) & (F.col("i") < i[1]) & (F.col("j") >= j[0]) & (F.col("j") < j[1])
            )
            renumbered = window.select(
                "local_t", "days", (F.col("i") - i[0]).alias("i"), (F.col("j") - j[0]).alias("j"), "lat", "lon", "value"
            )
            renumbered.sortWithinPartitions("local_t", "i", "j").write.mode("overwrite").parquet(out)
            written += 1
        variable_attrs, global_attrs = raw.attrs
        if not fs.exists(f"{folder}/{ATTRS_FILE}"):
            fs.write_new(f"{folder}/{ATTRS_FILE}", json.dumps({"variable": variable_attrs, "global": global_attrs}))
    return written
