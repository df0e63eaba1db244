"""Attributes as long tables (owner, key, value), so that they can be joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlaid(layers: Sequence[DataFrame]) -> DataFrame:
    """Later layers win, key by key."""
    stacked = layers[0].withColumn("_layer", F.lit(0))
    for position, layer in enumerate(layers[1:], start=1):
        stacked = stacked.unionByName(layer.withColumn("_layer", F.lit(position)))
    return stacked.groupBy("owner", "key").agg(F.max_by("value", "_layer").alias("value"))


def differing(here: DataFrame, there: DataFrame, exempt: Sequence[str] = ()) -> DataFrame:
    """Keys whose values differ, absence included. Exempt keys are not compared."""
    a = here.select("owner", "key", F.col("value").alias("here"))
    b = there.select("owner", "key", F.col("value").alias("there"))
    rows = a.join(b, ["owner", "key"], "full_outer").where(~F.col("here").eqNullSafe(F.col("there")))
    return rows.where(~F.col("key").isin(*exempt)) if exempt else rows


def lacking(attrs: DataFrame, required: Sequence[str]) -> DataFrame:
    """(owner, key) pairs that every owner must have and some have not."""
    needed = attrs.select("owner").distinct().select(
        "owner", F.explode(F.array(*[F.lit(k) for k in required])).alias("key")
    )
    return needed.join(attrs.select("owner", "key"), ["owner", "key"], "left_anti")
