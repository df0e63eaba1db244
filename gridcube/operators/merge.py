"""Bringing sibling variables, files and stores together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ("t", "i", "j")


class AxesDiffer(ValueError):
    """Variables that should share their axes do not."""


def positions(cells: DataFrame, axes: Sequence[str] = CELL) -> DataFrame:
    """(variable, axis, position): the axes that cells themselves span.

    Each cell contributes its position on every axis, and the distinct triples are far
    fewer than the cells. For sparse cells an axis may be longer than what they span.
    """
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).cast("long").alias("position")) for a in axes]))
    return cells.select("variable", each.alias("p")).select("variable", "p.axis", "p.position").distinct()


def axis_mismatches(axes: DataFrame, names: Sequence[str]) -> DataFrame:
    """(axis, position, n_variables): positions that not every variable's axis has.

    ``axes``: (variable, axis, position), each triple once.
    """
    return (
        axes.where(F.col("variable").isin(*names)).groupBy("axis", "position")
        .agg(F.count(F.lit(1)).alias("n_variables"))
        .where(F.col("n_variables") < len(names))
    )


def merge_exact(cells: DataFrame, names: Sequence[str], value: str = "value", axes: DataFrame | None = None) -> DataFrame:
    """One row per position, one column per variable, from equal axes only.

    ``axes`` are the variables' axes, which are compared; None where the caller has compared
    them. A missing cell is not a missing label, so cells do not stand in for axes. A single
    conditional aggregation on (t, i, j): one shuffle for any number of variables where a chain
    of joins would take one per variable.
    """
    if axes is not None:
        found = axis_mismatches(axes, names).orderBy("axis", "position").limit(1).collect()
        if found:
            raise AxesDiffer(f"{list(names)} differ on axis {found[0].axis!r}, at {found[0].position}")
    return (
        cells.where(F.col("variable").isin(*names))
        .groupBy(*CELL)
        .agg(*[F.max(F.when(F.col("variable") == n, F.col(value))).alias(n) for n in names])
    )


def compared(stored: DataFrame, raw: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Full outer comparison of two sparse cell tables.

    Adds ``mask_ok`` (present on both sides or neither) and ``value_ok`` (equal
    where both are present; exact, never a tolerance).
    """
    left = stored.select(*keys, F.col(value).alias("stored"))
    right = raw.select(*keys, F.col(value).alias("raw"))
    both = F.col("stored").isNotNull() & F.col("raw").isNotNull()
    return left.join(right, list(keys), "full_outer").select(
        *keys, "stored", "raw",
        both.alias("mask_ok"),
        (~both | (F.col("stored") == F.col("raw"))).alias("value_ok"),
    )


def comparison_totals(compared_cells: DataFrame, by: Sequence[str]) -> DataFrame:
    return compared_cells.groupBy(*by).agg(
        F.count_if(~F.col("mask_ok")).alias("n_mask_differs"),
        F.count_if(~F.col("value_ok")).alias("n_value_differs"),
        F.count_if(F.col("raw").isNotNull()).alias("n_valid"),
    )


def bisected(step: Column, firsts: Column) -> Column:
    """How many elements of a sorted array are at most ``step``: one bisection per row, halving from 2^30 down,
    whatever the array's length up to there."""
    strides = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    return F.aggregate(
        strides, F.lit(0),
        lambda at, stride: F.when((at + stride <= F.size(firsts)) & (F.get(firsts, at + stride - 1) <= step), at + stride).otherwise(at))


def locate(steps: DataFrame, files: DataFrame) -> DataFrame:
    """Global step -> (file, step within it).

    ``files`` has (variable, file, n_steps, first_step). A variable's file ranges become one sorted array, and each
    step finds its range there by bisection: an interval join without a row per step of a file. Steps that
    no file covers are left out.
    """
    ranges = files.where(F.col("n_steps") > 0).groupBy("variable").agg(
        F.array_sort(F.collect_list(F.struct(F.col("first_step").cast("long").alias("first"), F.col("n_steps").cast("long").alias("n"), "file"))).alias("_files"))
    found = steps.join(ranges, "variable").withColumn("_at", F.get("_files", bisected(F.col("t"), F.col("_files.first")) - 1))
    local = F.col("t") - F.col("_at.first")
    return found.where(local < F.col("_at.n")).select(*steps.columns, F.col("_at.file").alias("file"), local.alias("local_t"))


def axis_positions(labels: DataFrame, label: str) -> DataFrame:
    """(variable, idx, label): distinct labels numbered in order.

    The window holds one variable's distinct labels, which the calendar bounds.
    """
    order = Window.partitionBy("variable").orderBy(label)
    return labels.select("variable", label).distinct().withColumn(
        "idx", F.row_number().over(order) - 1
    )


def coordinates_equal(left: DataFrame, right: DataFrame, on: Sequence[str], label: str) -> DataFrame:
    """Per axis: do two coordinate tables hold the same labels in the same places?"""
    a = left.select(*on, F.col(label).alias("_a"), F.lit(True).alias("_here"))
    b = right.select(*on, F.col(label).alias("_b"), F.lit(True).alias("_there"))
    same = F.col("_here").isNotNull() & F.col("_there").isNotNull() & F.col("_a").eqNullSafe(F.col("_b"))
    return (
        a.join(b, list(on), "full_outer")
        .groupBy(*[c for c in on if c != "idx"])
        .agg(
            F.bool_and(same).alias("equal"),
            F.count_if(F.col("_here").isNotNull()).alias("n_left"),
            F.count_if(F.col("_there").isNotNull()).alias("n_right"),
        )
    )


def missing_from(expected: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """What was expected and is not there. ``on`` keys the anti join."""
    return expected.join(present.select(*on), list(on), "left_anti")


def with_canonical(rows: DataFrame, key: DataFrame, name: str) -> DataFrame:
    """Look names up in the key; an unknown one fails the query instead of vanishing."""
    found = rows.join(key, rows[name] == key["original"], "left")
    unknown = F.raise_error(F.concat(F.lit("no row in the key for "), F.col(name)))
    return found.withColumn(
        "canonical", F.when(F.col("canonical").isNotNull(), F.col("canonical")).otherwise(unknown)
    )


def ambiguous_names(key: DataFrame, column: str = "canonical") -> DataFrame:
    """Names that stand for more than one original: a key must have none."""
    return key.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def blocks(names: DataFrame, n_lat: Column, n_lon: Column, lat: int, lon: int) -> DataFrame:
    """Every (variable, i0, i1, j0, j1) block of the grid, clipped at its edges."""
    rows = F.explode(F.sequence(F.lit(0), n_lat - 1, F.lit(lat)))
    cols = F.explode(F.sequence(F.lit(0), n_lon - 1, F.lit(lon)))
    return (
        names.select("*", rows.alias("i0"))
        .select("*", cols.alias("j0"))
        .withColumn("i1", F.least(F.col("i0") + lat, n_lat))
        .withColumn("j1", F.least(F.col("j0") + lon, n_lon))
    )
