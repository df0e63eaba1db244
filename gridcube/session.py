"""Session settings and the shared folder for checkpoints and scratch stores."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Settings that change how the work runs, never what it returns.
TUNING = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession, **overrides) -> SparkSession:
    """Apply the session settings the package relies on."""
    for key, value in {**TUNING, **overrides}.items():
        spark.conf.set(key, str(value))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local temporary folder is used only where the session names none and runs on one
    machine (tests, notebooks). On a cluster a missing setting is an error: executors
    would each write to a disk of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        root = configured
    else:
        active = spark.sparkContext._jsc.sc().getCheckpointDir()
        if active.isDefined():
            return active.get()
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"on {master!r}, spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gridcube-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of the executors that computed it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def side_by_side(work: Callable, items: Sequence, at_once: int | None = None) -> list:
    """Run independent pieces of driver work, a few at a time, in order of the items.

    Each piece submits Spark jobs of its own; the scheduler shares the slots out.
    """
    with ThreadPoolExecutor(max_workers=max(1, at_once or 8)) as pool:
        return list(pool.map(work, items))
