"""A small family of four variables in both layouts, built once per test session."""

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridcube.config import GridConfig  # noqa: E402
from gridcube.plans.build import build_family  # noqa: E402
from gridcube.session import tune  # noqa: E402

N_LAT, N_LON, FIRST_DAY = 20, 40, 29219
FILES = {"1980": (0, 31), "1981": (31, 60)}
GAP = range(4, 9)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)


def settings(root, layout, **changes):
    spatial = layout == "spatial"
    base = {
        "directories": {"download": str(root), "logs": str(root)},
        "output_conventions": {"filename": "{suffix}/{dataset}.{version}.{temporal_frequency}.{variable}", "suffix": layout},
        "dataset": "fluxes", "version": "v1.2b", "variables": "all", "temporal_resolution": "daily",
        "chunks": {"time": 1, "lat": -1, "lon": -1} if spatial else {"time": -1, "lat": 5, "lon": 10},
        "write_strategy": "append" if spatial else "region",
        "timesteps_per_commit": 25,
        "block_shape": {"lat": 10, "lon": -1},
        "attrs": {
            "Conventions": "ACDD-1.3", "source": "{version_label} {temporal_resolution} files of {original_variable}",
            "chunking": "(time, lat, lon) = " + ("(1, 20, 40)" if spatial else "(60, 5, 10)") + ", float32",
        },
        "variable_attrs": {"E": {"known_data_gaps": "five days of {variable}"}},
    }
    return {**base, **changes}


def raw_frame(spark, name, first, last):
    """Land is j >= 15. The valid footprint moves by day, E is all fill on the gap days,
    Ep is the float32 sum of its parts except for some capped cells."""
    cells = spark.range((last - first) * N_LAT * N_LON).select(
        (F.expr(f"id div {N_LAT * N_LON}")).cast("int").alias("local_t"),
        (F.expr(f"(id div {N_LON}) % {N_LAT}")).cast("int").alias("i"), (F.col("id") % N_LON).cast("int").alias("j"),
    ).withColumn("t", F.col("local_t") + first)
    t, i, j = F.col("t"), F.col("i"), F.col("j")
    aero = ((t * 7 + i * 3 + j * 5) % 41 / 8.3).cast("float")
    rad = ((t * 5 + i * 11 + j * 2) % 37 / 9.7).cast("float")
    total = F.when((i == 12) & (j == 30), F.lit(2.5).cast("float")).otherwise(aero + rad)
    value = {"E": ((t * 3 + i + j * 2) % 29 / 6.1).cast("float"), "Ep": total, "Ep_aero": aero, "Ep_rad": rad}[name]
    land = (j >= 15) & ((i + j + t) % 13 != 0)
    if name == "E":
        land = land & ~t.isin(*GAP)
    else:
        land = land | ((i == 2) & (j == 3) & (t == 44))  # one valid cell in an ocean tile
    return cells.select(
        "local_t", (t + FIRST_DAY).cast("long").alias("days"), "i", "j",
        (F.lit(50.0) - i * 0.5).alias("lat"), (F.lit(-20.0) + j * 0.5).alias("lon"),
        F.when(land, value).otherwise(F.lit(-999.0).cast("float")).alias("value"),
    )


def write_raw(spark, config, name, files=FILES):
    folder = Path(config.raw_dir) / name
    for year, (first, last) in files.items():
        raw_frame(spark, name, first, last).repartition(2).sortWithinPartitions("local_t", "i", "j").write.mode("overwrite").parquet(
            str(folder / f"{name}_{year}_fluxes.parquet")
        )
    attrs = {"variable": {"standard_name": f"std_{name}", "long_name": f"{name} flux from fluxes 1.2b", "units": "mm.day-1"},
             "global": {"institution": "somewhere"}}
    (folder / "_attrs.json").write_text(json.dumps(attrs))


@pytest.fixture(scope="session")
def family(spark, tmp_path_factory):
    """(spatial config, temporal config) over built stores. Tests must not change these."""
    root = tmp_path_factory.mktemp("family")
    configs = {layout: GridConfig(settings(root, layout)) for layout in ("spatial", "temporal")}
    for name in ("E", "Ep", "Ep_aero", "Ep_rad"):
        write_raw(spark, configs["spatial"], name)
    for config in configs.values():
        build_family(spark, config)
    return configs


@pytest.fixture()
def lone(spark, tmp_path):
    """Raw E alone in a folder of its own, nothing built."""
    def make(layout="spatial", **changes):
        config = GridConfig(settings(tmp_path, layout, **changes))
        if not (tmp_path / "v_1_2_b").exists():
            write_raw(spark, config, "E")
        return config.of("E")

    return make
