"""Commit chains as tables: depth from the tip, and what the chains still reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.session import cut_lineage


def depth_from_tip(commits: DataFrame, id_column: str, parent_column: str) -> DataFrame:
    """Adds ``depth``: steps from the newest commit of the chain (0) back to each one.

    Pointer doubling: after round k every commit knows the one 2^k steps nearer the
    tip, so a chain of n commits takes log2(n) equi-joins, however long a single
    chain is. Chains must not branch; one that closes on itself is an error.
    """
    child = commits.select(F.col(parent_column).alias(id_column), F.col(id_column).alias("_next"))
    state = commits.select(id_column).join(child.where(F.col(id_column).isNotNull()), id_column, "left")
    state = state.withColumn("_far", F.when(F.col("_next").isNotNull(), 1).otherwise(0).cast("long"))
    rounds = None
    while True:
        state = cut_lineage(state)
        seen = state.agg(F.count(F.lit(1)).alias("n"), F.count("_next").alias("open")).first()
        if not seen.open:
            break
        rounds = seen.n.bit_length() + 1 if rounds is None else rounds - 1
        if rounds == 0:
            raise ValueError(f"the chain of {id_column!r} closes on itself")
        hop = state.select(
            F.col(id_column).alias("_at"), F.col("_next").alias("_then"), F.col("_far").alias("_more")
        )
        state = state.join(hop, F.col("_next") == F.col("_at"), "left").select(
            id_column, F.col("_then").alias("_next"),
            (F.col("_far") + F.coalesce("_more", F.lit(0))).alias("_far"),
        )
    return commits.join(state.select(id_column, F.col("_far").alias("depth")), id_column)


def unreachable(objects: DataFrame, reachable: DataFrame, on: str = "snapshot_id") -> DataFrame:
    """Stored objects that no reachable snapshot refers to."""
    return objects.join(reachable.select(on).distinct(), on, "left_anti")
