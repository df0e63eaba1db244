"""Axes as runs: an axis of days is a few stretches without a gap, and is compared, and its holes are told, by those.

A run is ``first_idx, first, last, n_steps``: from index first_idx on, labels go up by one a step. A daily record
of any length is one run, so what travels between two axes, or is kept of one, does not grow with the record.
The window that finds runs holds one variable's axis, which the calendar bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN = ("first_idx", "first", "last", "n_steps")


def runs(axes: DataFrame, by: Sequence[str] = (), label: str = "days") -> DataFrame:
    """(by, first_idx, first, last, n_steps) of axes given as (by, idx, label): gaps and islands.

    A label that repeats, falls or leaps starts a run, and so does an index that does.
    """
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    order = whole.orderBy("idx", "_label")
    leaps = lambda c: ~F.coalesce(F.col(c) - F.lag(c).over(order) == 1, F.lit(False))
    marked = axes.select(*by, "idx", F.col(label).alias("_label"))
    numbered = marked.withColumn("_starts", (leaps("idx") | leaps("_label")).cast("int")).withColumn(
        "_run", F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*by, "_run").agg(
        F.min("idx").cast("long").alias("first_idx"), F.min("_label").cast("long").alias("first"),
        F.max("_label").cast("long").alias("last"), F.count(F.lit(1)).alias("n_steps")).drop("_run")


def unlike_runs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Runs that only one of two axes has: none exactly where both hold the same labels in the same places."""
    side = lambda of, n: runs(of).withColumn("side", F.lit(n))
    return side(left, "left").unionByName(side(right, "right")).groupBy(*RUN).agg(
        F.count(F.lit(1)).alias("n"), F.min("side").alias("side"), F.max("side").alias("_other")
    ).where("n <> 2 or side = _other").select("side", *RUN)


def against_reference(found: DataFrame, names: Sequence[str], reference: str) -> DataFrame:
    """(variable, n_steps, n_reference, first_difference) from the runs of several variables.

    first_difference is the first index at which a variable lacks the reference's label or has one of
    its own; null where there is none. Axes that differ first do so where a run of either starts alone, or right after
    the shorter of two runs that start together, so no label is looked at.
    """
    lengths = F.map_from_entries(F.collect_list(F.struct("variable", "n_steps")))
    starts = found.groupBy("variable", "first_idx", "first").agg(F.max("n_steps").alias("n_steps")).groupBy("first_idx", "first").agg(lengths.alias("_held"))
    each = starts.select("first_idx", "_held", F.explode(F.array(*map(F.lit, names))).alias("variable")).select(
        "variable", "first_idx", F.expr("_held[variable]").alias("_mine"), F.col("_held")[reference].alias("_theirs"))
    mine, theirs = F.col("_mine"), F.col("_theirs")
    at = F.when(mine.isNotNull() & theirs.isNotNull(), F.col("first_idx") + F.least(mine, theirs)).otherwise(F.col("first_idx"))
    return each.groupBy("variable").agg(
        F.coalesce(F.sum("_mine"), F.lit(0)).alias("n_steps"), F.coalesce(F.sum("_theirs"), F.lit(0)).alias("n_reference"),
        F.min(F.when(~mine.eqNullSafe(theirs), at)).alias("first_difference"))


def absent(found: DataFrame, first: int, last: int, by: Sequence[str] = ("variable",)) -> DataFrame:
    """(by, first, last, n_steps): what the runs leave out of first..last, as ranges.

    The window holds one variable's runs. Runs may overlap or repeat; parts outside first..last do not count.
    """
    order = Window.partitionBy(*by).orderBy("first", "last")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("last").over(before), F.lit(first - 1))
    ends = found.groupBy(*by).agg(F.lit(last + 1).cast("long").alias("first"), F.lit(last + 1).cast("long").alias("last"))
    holes = found.select(*by, "first", "last").unionByName(ends).select(
        *by, (F.greatest(reached, F.lit(first - 1)) + 1).alias("_a"), F.least(F.col("first") - 1, F.lit(last)).alias("_b"))
    return holes.where("_a <= _b").select(*by, F.col("_a").alias("first"), F.col("_b").alias("last"), (F.col("_b") - F.col("_a") + 1).alias("n_steps"))
