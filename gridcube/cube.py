"""Reading stores: labels in, cells out.

Label selections are turned into index ranges on the driver, from axes of a few
thousand rows, and reach the scan as plain comparisons of t, i and j. They choose
the commits to open, and Parquet statistics choose the row groups in them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property, reduce as fold

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcube.config import GridConfig
from gridcube.fs import SharedFs
from gridcube.functions import grid
from gridcube.functions.fixed import BRANCH
from gridcube.functions.quantiles import robust_limits
from gridcube.operators import chunks as chunk_ops
from gridcube.operators import merge, reduce, select
from gridcube.plans.store import Store

BROADCAST_ROWS = 1_000_000


def attached(cells: DataFrame, axis: DataFrame, index: str, label: str, name: str, n_rows: int) -> DataFrame:
    """Add an axis label to cells. The axis is broadcast only up to a checked length."""
    side = axis.select(F.col("idx").alias(index), label.alias(name) if isinstance(label, Column) else F.col(label).alias(name))
    return cells.join(F.broadcast(side) if n_rows <= BROADCAST_ROWS else side, index)


class Cube:
    """Some variables of one layout, on equal axes, restricted to some index ranges."""

    def __init__(self, stores: dict[str, Store], ref: str = BRANCH, ranges: dict | None = None):
        if not stores:
            raise ValueError("a cube needs at least one variable")
        self.stores, self.ref, self.ranges = stores, ref, dict(ranges or {})

    @classmethod
    def open(cls, spark: SparkSession, config: GridConfig, names: Sequence[str], ref: str = BRANCH) -> Cube:
        """Open variables by either spelling. Unequal axes are an error, never an outer join."""
        originals = [config.key.resolve(n) for n in names]
        cube = cls({config.key.canonical(n): Store.open(spark, config.of(n).store_path) for n in originals}, ref)
        labels = fold(DataFrame.unionByName, [
            s.dims(ref).where((F.col("dim") != "time") | (F.col("idx") < s.state(ref)["sizes"]["time"])) for s in cube.stores.values()
        ])
        # one job for all axes of all stores: every label must be there as often as there are stores
        unlike = labels.groupBy("dim", "idx", "value", "days").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != len(cube.stores))
        found = unlike.orderBy("dim", "idx").limit(1).collect() if len(cube.stores) > 1 else []
        if found:
            raise merge.AxesDiffer(f"{list(cube.stores)} differ on axis {found[0].dim!r}, at {found[0].idx}")
        return cube

    @property
    def _first(self) -> Store:
        return next(iter(self.stores.values()))

    @cached_property
    def state(self) -> dict:
        return self._first.state(self.ref)

    def attrs(self, name: str) -> dict:
        return self.stores[name].state(self.ref)["variables"][name]["attrs"]

    def label(self, name: str) -> str:
        """'Total evaporation flux [mm d-1]', for an axis or a colour bar."""
        held = self.attrs(name)
        long_name = str(held.get("long_name", name))
        return f"{long_name[:1].upper()}{long_name[1:]} [{held.get('units', '')}]"

    # -- selecting

    def _narrowed(self, **ranges) -> Cube:
        merged = dict(self.ranges)
        for axis, (a, b) in ranges.items():
            old = merged.get(axis, (a, b))
            merged[axis] = (max(a, old[0]), min(b, old[1]))
        return Cube(self.stores, self.ref, merged)

    def isel(self, **ranges: tuple[int, int]) -> Cube:
        return self._narrowed(**ranges)

    def of(self, *names: str) -> Cube:
        return Cube({n: self.stores[n] for n in names}, self.ref, self.ranges)

    @staticmethod
    def _span(axis: DataFrame) -> tuple[int, int]:
        found = axis.agg(F.min("idx").alias("a"), F.max("idx").alias("b")).first()
        return (0, 0) if found.a is None else (found.a, found.b + 1)

    def sel(
        self, time: str | tuple[str, str] | None = None,
        lat: tuple[float, float] | None = None, lon: tuple[float, float] | None = None,
    ) -> Cube:
        """By label. Dates may be partial ('2020-07'); ranges include both ends and are
        given in storage order, so latitude runs from north to south."""
        ranges = {}
        if time is not None:
            first, last = (time, time) if isinstance(time, str) else time
            dated = self._first.axis(self.ref).withColumn("date", grid.day_date(F.col("days")))
            ranges["t"] = self._span(select.sel_time(dated, first, last))
        for axis, dim, span in (("i", "lat", lat), ("j", "lon", lon)):
            if span is None:
                continue
            labels = self._first.coordinate(dim, self.ref)
            ends = labels.agg(F.min_by("value", "idx").alias("a"), F.max_by("value", "idx").alias("b")).first()
            pick = select.sel_descending if ends.a > ends.b else select.sel_ascending
            ranges[axis] = self._span(pick(labels, "value", *span))
        return self._narrowed(**ranges)

    def nearest(self, lat: float | None = None, lon: float | None = None) -> Cube:
        """The row and column nearest to a point."""
        ranges = {}
        for axis, dim, target in (("i", "lat", lat), ("j", "lon", lon)):
            if target is not None:
                at = select.nearest(self._first.coordinate(dim, self.ref), "idx", "value", target).first().idx
                ranges[axis] = (at, at + 1)
        return self._narrowed(**ranges)

    # -- reading

    def cells(self, labels: bool = True) -> DataFrame:
        """variable, t, i, j, value, and date, lat, lon where ``labels`` is set."""
        scans = [
            s.cells(self.ref, **self.ranges).select(F.lit(n).alias("variable"), "t", "i", "j", "value")
            for n, s in self.stores.items()
        ]
        cells = fold(DataFrame.unionByName, scans)
        if not labels:
            return cells
        sizes, first = self.state["sizes"], self._first
        cells = attached(cells, first.axis(self.ref), "t", grid.day_date(F.col("days")), "date", sizes["time"])
        cells = attached(cells, first.coordinate("lat", self.ref), "i", "value", "lat", sizes["lat"])
        return attached(cells, first.coordinate("lon", self.ref), "j", "value", "lon", sizes["lon"])

    def wide(self) -> DataFrame:
        """t, i, j and one column per variable."""
        return merge.merge_exact(self.cells(labels=False), list(self.stores))  # axes were compared by open()

    def map(self) -> DataFrame:
        """variable, lat, lon, value with rows counted from the north: an image, as rows."""
        sizes = self.state["sizes"]
        ends = self._first.coordinate("lat", self.ref).agg(
            F.min_by("value", "idx").alias("a"), F.max_by("value", "idx").alias("b")
        ).first()
        row = select.north_up(F.col("i"), sizes["lat"], ascending=ends.a < ends.b)
        return self.cells().select("variable", "t", row.alias("row"), "j", "lat", "lon", "value")

    def extent(self) -> tuple[float, float, float, float]:
        """West, east, south, north of the selection: labels are centres, so half a cell more."""
        sizes, out = self.state["sizes"], {}
        for axis, dim in (("j", "lon"), ("i", "lat")):
            a, b = self.ranges.get(axis, (0, sizes[dim]))
            step = self.state["attrs"][f"geospatial_{dim}_resolution"]
            labels = self._first.coordinate(dim, self.ref).where(F.col("idx").between(a, b - 1))
            found = labels.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).first()
            out[dim] = (found.lo - step / 2, found.hi + step / 2)
        return (*out["lon"], *out["lat"])

    def land_mean(self, by: Sequence[str] = ("variable",)) -> DataFrame:
        return reduce.land_mean(self.cells(), list(by), F.col("lat"))

    def time_mean(self) -> DataFrame:
        return reduce.time_mean(self.cells(), ["variable", "i", "j", "lat", "lon"])

    def annual_mean(self, by: Sequence[str] = ("variable",)) -> DataFrame:
        return reduce.annual_mean(self.cells(), list(by))

    def robust_limits(self, low: float = 2.0, high: float = 98.0, symmetric: bool = False) -> DataFrame:
        return robust_limits(self.cells(labels=False), ["variable"], "value", low, high, symmetric)

    def shares(self, total: str) -> DataFrame:
        """Land means of the other variables over the total's footprint, and their shares."""
        parts = [n for n in self.stores if n != total]
        wide = attached(self.wide(), self._first.coordinate("lat", self.ref), "i", "value", "lat", self.state["sizes"]["lat"])
        return reduce.component_shares(wide, total, parts, F.col("lat"))

    def read_cost(self) -> DataFrame:
        """(variable, n_chunks, mib): grid chunks under the selection. Absent ones cost nothing."""
        per_chunk = self.state["chunks"]
        sizes = self.state["sizes"]
        mib = per_chunk["time"] * per_chunk["lat"] * per_chunk["lon"] * 4 / 2**20
        tables = []
        for name, store in self.stores.items():
            rows = store.manifest(self.ref)
            for axis, dim, column in (("t", "time", "ct"), ("i", "lat", "ci"), ("j", "lon", "cj")):
                a, b = self.ranges.get(axis, (0, sizes[dim]))
                rows = rows.where(F.col(column).between(a // per_chunk[dim], (b - 1) // per_chunk[dim]))
            tables.append(rows.withColumn("variable", F.lit(name)))
        return chunk_ops.read_cost(fold(DataFrame.unionByName, tables), ["variable"], mib)


def inventory(spark: SparkSession, config: GridConfig) -> DataFrame:
    """One row per built variable, from metadata alone."""
    rows = []
    for name in config.family(SharedFs(spark, config.raw_dir)):
        path = config.of(name).store_path
        if not Store.exists(spark, path):
            continue
        state = Store(spark, path).state()
        for canonical, variable in state["variables"].items():
            n_cells = state["sizes"]["time"] * state["sizes"]["lat"] * state["sizes"]["lon"]
            a = variable["attrs"]
            rows.append((name, canonical, a.get("units"), a.get("long_name"), a.get("original_units"), n_cells * 4 / 2**30))
    schema = "original string, variable string, units string, long_name string, original_units string, gib double"
    return spark.createDataFrame(rows, schema)
