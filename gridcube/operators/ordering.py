"""Offsets, gaps, rankings and seeded draws.

Windows here run over axes, file lists and tile lists, which the calendar and the
chunk grid bound. Rankings over anything larger go through ``smallest_per_group``,
which cuts every group down in salted parts first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcube.functions.grid import draw_key


def file_offsets(files: DataFrame) -> DataFrame:
    """Adds ``first_step``: the steps before each file, per variable in file order."""
    before = Window.partitionBy("variable").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_step", F.coalesce(F.sum("n_steps").over(before), F.lit(0)))


def axis_gaps(axis: DataFrame, day: str = "days") -> DataFrame:
    """Steps of an axis that are not exactly one day after the step before."""
    order = Window.partitionBy("variable").orderBy("idx")
    stepped = axis.withColumn("step", F.col(day) - F.lag(day).over(order))
    return stepped.where(F.col("step").isNotNull() & (F.col("step") != 1))


def grid_step(axis: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """The distance between the first two labels of a regular axis."""
    first = F.max(F.when(F.col("idx") == 0, F.col(label)))
    second = F.max(F.when(F.col("idx") == 1, F.col(label)))
    return axis.groupBy(*by).agg(F.round(F.abs(second - first), 4).alias("grid_step"))


def contiguity(chunks: DataFrame, by: Sequence[str], index: str) -> DataFrame:
    """Per group: do the chunk numbers run 0, 1, 2, ... without a hole?

    n distinct numbers from 0 to n - 1 cannot have one, so no ordering is needed.
    """
    return (
        chunks.select(*by, index).distinct().groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_chunks"), F.min(index).alias("_lo"), F.max(index).alias("_hi"))
        .select(
            *by, "n_chunks",
            ((F.col("_lo") == 0) & (F.col("_hi") == F.col("n_chunks") - 1)).alias("contiguous"),
        )
    )


def smallest_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, salts: int = 64
) -> DataFrame:
    """The k first rows of every group, with their ``rank`` from 1.

    A group may hold a third of all rows, so it is ranked in salted parts first;
    at most ``salts * k`` rows of it reach the second ranking. ``order`` must be
    total within a group.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(salts)))
    part = Window.partitionBy(*group, "_salt").orderBy(*order)
    kept = salted.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= k).drop("_r", "_salt")
    whole = Window.partitionBy(*group).orderBy(*order)
    return kept.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def draw(df: DataFrame, group: Sequence[str], identity: Sequence[str], k: int, seed: int) -> DataFrame:
    """k seeded random rows per group, without replacement."""
    order = [draw_key(seed, *[F.col(c) for c in identity]), *[F.col(c) for c in identity]]
    return smallest_per_group(df, group, order, k)


def alternated(drawn: DataFrame, by: Sequence[str], stratum: str, k: int) -> DataFrame:
    """First k of each group taking the strata in turn, so that none takes all places.

    ``drawn`` carries ``rank`` within (group, stratum), as ``draw`` leaves it.
    """
    turn = Window.partitionBy(*by).orderBy("rank", stratum)
    return drawn.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= k)


def rotated(position: Column, choices: Sequence[Column]) -> Column:
    """Position p takes choice p modulo the number of choices."""
    return F.element_at(F.array(*choices), F.pmod(position, F.lit(len(choices))).cast("int") + 1)


def spread_positions(n: Column, k: int) -> Column:
    """Array of distinct positions evenly spread over 0..n-1, half rounded to even."""
    last = (n - 1).cast("double")
    if k < 2:
        return F.array(F.lit(0).cast("long"))
    step = last / (k - 1)
    inner = F.transform(F.sequence(F.lit(0), F.lit(k - 2)), lambda p: F.bround(p * step).cast("long"))
    return F.array_sort(F.array_distinct(F.concat(inner, F.array(last.cast("long")))))


def edge_positions(n: Column, batch: int) -> Column:
    """Positions worth reading on purpose: both ends, and around every commit edge."""
    ends = F.array(F.lit(0).cast("long"), n - 1, n - 2)
    edges = F.when(
        n > batch,
        F.flatten(F.transform(
            F.sequence(F.lit(batch).cast("long"), n - 1, F.lit(batch).cast("long")),
            lambda e: F.array(e - 1, e, e + 1),
        )),
    ).otherwise(F.expr("cast(array() as array<bigint>)"))
    inside = F.filter(F.concat(ends, edges), lambda p: (p >= 0) & (p < n))
    return F.array_sort(F.array_distinct(inside))
