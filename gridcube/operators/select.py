"""Selections: by position, by label, by nearest label, by mask."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Range = tuple[int, int]


def isel(cells: DataFrame, **ranges: Range) -> DataFrame:
    """Half-open positional ranges, e.g. ``isel(cells, t=(0, 10), i=(5, 20))``."""
    for axis, (start, stop) in ranges.items():
        cells = cells.where((F.col(axis) >= start) & (F.col(axis) < stop))
    return cells


def period(label: str) -> tuple[dt.date, dt.date]:
    """The half-open date range a full or partial date names: a day, month or year."""
    parts = [int(p) for p in label.split("-")]
    if len(parts) == 3:
        start = dt.date(*parts)
        return start, start + dt.timedelta(days=1)
    if len(parts) == 2:
        year, month = parts
        return dt.date(year, month, 1), dt.date(year + month // 12, month % 12 + 1, 1)
    return dt.date(parts[0], 1, 1), dt.date(parts[0] + 1, 1, 1)


def sel_time(cells: DataFrame, first: str, last: str | None = None, column: str = "date") -> DataFrame:
    """Dates by label; both ends belong to the selection and may be partial."""
    start, stop = period(first)[0], period(last or first)[1]
    return cells.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(stop)))


def sel_descending(cells: DataFrame, column: str, first: float, last: float) -> DataFrame:
    """Inclusive label range along an axis stored in descending order (latitude).

    Labels are given in storage order; the other order selects nothing.
    """
    return cells.where((F.col(column) <= first) & (F.col(column) >= last))


def sel_ascending(cells: DataFrame, column: str, first: float, last: float) -> DataFrame:
    return cells.where((F.col(column) >= first) & (F.col(column) <= last))


def nearest(axis: DataFrame, index: str, coordinate: str, target: float) -> DataFrame:
    """One row with the index whose label is nearest; ties go to the lower index."""
    distance = F.struct(F.abs(F.col(coordinate) - F.lit(float(target))), F.col(index))
    return axis.agg(F.min_by(index, distance).alias(index))


def masked_to(cells: DataFrame, footprint: DataFrame, on: Sequence[str]) -> DataFrame:
    """Only the cells whose position appears in the footprint."""
    return cells.join(footprint.select(*on), list(on), "left_semi")


def of_variables(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    return cells.where(F.col("variable").isin(*names))


def north_up(index: Column, n_rows: int, ascending: bool) -> Column:
    """Row position counted from the north, whichever way latitude is stored."""
    return F.lit(n_rows - 1) - index if ascending else index
