"""Undecoded source files of one variable, as one table of cells.

A source file holds some consecutive time steps of the whole grid, one row per
cell, the sentinel where data is missing::

    local_t INT, days BIGINT, i INT, j INT, lat DOUBLE, lon DOUBLE, value FLOAT

Parquet files are read by Spark directly; netCDF files through the data source in
``gridcube.sources.netcdf``, which yields the same columns.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcube.config import GridConfig
from gridcube.fs import SharedFs
from gridcube.functions.grid import decoded
from gridcube.operators import axes
from gridcube.sources.footers import footers, listed, reachable

SCHEMA = "local_t INT, days BIGINT, i INT, j INT, lat DOUBLE, lon DOUBLE, value FLOAT"
ATTRS_FILE = "_attrs.json"


FEW_FILES = 32  # so many are named to a scan one by one
BROADCAST_FILES = 100_000  # at most so many data files are sent to every task with their first steps


class RawVariable:
    """All files of one variable. Nothing is read before it is needed."""

    def __init__(self, spark: SparkSession, config: GridConfig, variable: str):
        self.spark, self.name = spark, variable
        self._fs = SharedFs(spark, config.raw_dir)
        self._folder = f"{config.raw_dir}/{variable}"
        self._options = config.settings.get("raw_options") or {}
        self.files = config.files(self._fs, variable)
        self._netcdf = self.files[0].endswith(".nc")

    def _scan(self, files: list[str], header: bool = False) -> DataFrame:
        """Rows of any number of files, one scan, with what tells their file: its name, or where a Parquet data
        file lies. ``header``: only steps and days are wanted. Parquet then gives the rows of the first cell
        alone, whose pages the sort order sets apart; the netCDF source reads the time variable only."""
        if self._netcdf:
            from gridcube.sources.netcdf import read_netcdf

            return read_netcdf(self.spark, files, self.name, header=str(header).lower(), **self._options)
        # many files are listed by their folder and not one by one; scans open those whose paths are asked for
        reader = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        rows = reader.parquet(*files) if len(files) <= FEW_FILES else reader.parquet(self._folder)
        # a data file's path is one constant for all its rows; nothing is cut out of it row by row
        rows = rows.select("*", F.col("_metadata.file_path").alias("file"))
        return rows.where("i = 0 and j = 0") if header else rows

    @cached_property
    def _lengths(self) -> list[tuple[str, str, int]]:
        """(what ``_scan`` calls the file, its name here, steps it reaches to), a row per data file. Of Parquet
        only footers are read, or, where these say nothing, the one column."""
        reach = (F.max("local_t") + 1).alias("n")
        if self._netcdf:
            return [(r.file, r.file, r.n) for r in self._scan(self.files, header=True).groupBy("file").agg(reach).collect()]
        spelled = lambda path: path.rsplit(f"/{self.name}/", 1)[1].split("/", 1)[0]
        files = listed(self.spark, self.files if len(self.files) <= FEW_FILES else [self._folder])
        if reachable(self.files[0]):
            ends = footers(files, ["local_t"]).select("file_path", "path", "n_rows", (F.col("extremes")["local_t"]["high"] + 1).cast("int").alias("n"), "problem").collect()
        else:
            ends = files.select("file_path", "path", F.lit(None).cast("long").alias("n_rows"), F.lit(None).cast("int").alias("n"), F.lit(None).alias("problem")).collect()
        silent = [r.path for r in ends if r.n is None and r.n_rows != 0]
        told = {}
        if silent:
            told = {r.file: r.n for r in self._scan(silent).groupBy("file").agg(reach).collect()}
        return [(r.file_path, spelled(r.path), r.n or told.get(r.file_path, 0)) for r in ends]

    @cached_property
    def index(self) -> list[tuple[str, int, int]]:
        """(file, first step, number of steps), in time order: one row per file."""
        lengths: dict[str, int] = {}
        for _, name, n in self._lengths:
            lengths[name] = max(n, lengths.get(name, 0))
        table, first = [], 0
        for path in self.files:
            n = lengths.get(path.rsplit("/", 1)[1], 0)
            table.append((path, first, n))
            first += n
        return table

    @property
    def n_steps(self) -> int:
        return self.index[-1][1] + self.index[-1][2]

    def locate(self, t: int) -> tuple[str, int]:
        """The file a step lies in, and its place there."""
        path, first, _ = self.index[bisect_right(self._firsts, t) - 1]
        return path, t - first

    @cached_property
    def _firsts(self) -> list[int]:
        return [first for _, first, _ in self.index]

    def n_files(self, first: int, last: int) -> int:
        """How many files hold steps of a half-open range."""
        return sum(f < last and first < f + n for _, f, n in self.index)

    def seams(self) -> list[int]:
        return [first for _, first, _ in self.index[1:]]

    def _placed(self, files: list[str], test: Column | None = None, header: bool = False) -> DataFrame:
        """Rows of some files with their global step ``t``: one scan, joined to the files' first steps."""
        rows = self._scan(files, header)
        if test is not None:
            rows = rows.where(test)
        first = {path: f for path, f, _ in self.index}
        if len(files) == 1:
            return rows.withColumn("t", F.col("local_t") + F.lit(first[files[0]]))
        by_name = {path.rsplit("/", 1)[1]: first[path] for path in files}
        starts = [(key, by_name[name]) for key, name, _ in self._lengths if name in by_name]
        if len(files) > FEW_FILES and len(starts) < len(self._lengths):
            rows = rows.where(F.col("file").between(min(key for key, _ in starts), max(key for key, _ in starts)))
        table = self.spark.createDataFrame(starts, "file string, first int")
        if len(starts) <= BROADCAST_FILES:
            table = F.broadcast(table)
        return rows.join(table, "file").withColumn("t", F.col("local_t") + F.col("first"))

    def axis(self) -> DataFrame:
        """(idx, days): the time axis, without touching the data column."""
        return self._placed(self.files, header=True).select(F.col("t").alias("idx"), "days").distinct()

    def coordinate(self, dim: str) -> DataFrame:
        """(idx, value) of lat or lon, from one step of the first file: files share their grid."""
        index = {"lat": "i", "lon": "j"}[dim]
        first = self._first_plane()
        return first.select(F.col(index).alias("idx"), F.col(dim).alias("value")).distinct()

    def _first_plane(self) -> DataFrame:
        return self._scan(self.files[:1]).where("local_t = 0")

    @cached_property
    def extent(self) -> dict:
        """Size, extremes and step of both coordinates, from one plane in one job."""
        found = []
        for dim, index in (("lat", "i"), ("lon", "j")):
            at = lambda k: F.max(F.when(F.col(index) == k, F.col(dim)))
            found += [
                F.countDistinct(index).alias(f"n_{dim}"),
                F.round(F.min(dim), 4).alias(f"{dim}_min"), F.round(F.max(dim), 4).alias(f"{dim}_max"),
                F.round(F.abs(at(1) - at(0)), 4).alias(f"{dim}_resolution"),
            ]
        return self._first_plane().agg(*found).first().asDict()

    def cells(
        self, steps: tuple[int, int] | None = None, days: Iterable[int] | None = None,
        i: tuple[int, int] | None = None, j: tuple[int, int] | None = None,
    ) -> DataFrame:
        """(t, i, j, value) with the sentinel intact, for a step range or single steps.

        Files outside the steps are not opened, and the steps wanted from a file are pushed down into its
        scan: files wanted whole share one scan, the two that a range cuts have their own. Single steps
        come from one scan of their files, which takes the places that any of them has in its file.
        """
        if days is not None:
            wanted = sorted({t for t in days if 0 <= t < self.n_steps})
            places = [self.locate(t) for t in wanted]
            files = list(dict.fromkeys(path for path, _ in places)) or self.files[:1]
            rows = self._placed(files, F.col("local_t").isin(sorted({k for _, k in places}))).where(F.col("t").isin(wanted))
        else:
            whole, parts = [], []
            for path, first, n in self.index:
                a, b = (0, n) if steps is None else (max(0, steps[0] - first), min(n, steps[1] - first))
                if (a, b) == (0, n):
                    whole.append(path)
                elif a < b:
                    parts.append(([path], (F.col("local_t") >= a) & (F.col("local_t") < b)))
            if whole or not parts:
                parts.insert(0, (whole or self.files[:1], None if whole else F.lit(False)))
            rows = reduce(DataFrame.unionByName, [self._placed(files, test).select("t", "i", "j", "value") for files, test in parts])
        for axis, span in (("i", i), ("j", j)):
            if span is not None:
                rows = rows.where((F.col(axis) >= span[0]) & (F.col(axis) < span[1]))
        return rows.select("t", "i", "j", "value")

    def valid_cells(self, **where) -> DataFrame:
        """Decoded cells that carry data: what a store should hold."""
        rows = self.cells(**where)
        return rows.withColumn("value", decoded(F.col("value"))).where(F.col("value").isNotNull())

    @cached_property
    def attrs(self) -> tuple[dict, dict]:
        """(variable attributes, global attributes) as published."""
        if self.files[0].endswith(".nc"):
            from gridcube.sources.netcdf import read_attrs

            return read_attrs(self.files[0], self.name, **{k: v for k, v in self._options.items() if k == "opener"})
        path = f"{self._folder}/{ATTRS_FILE}"
        if not self._fs.exists(path):
            return {}, {}
        held = json.loads(self._fs.read_text(path))
        return held.get("variable", {}), held.get("global", {})


def axis_disagreement(variable: RawVariable, reference: RawVariable) -> str | None:
    """Why a variable does not cover the reference's time steps, or None."""
    if variable.name == reference.name:
        return None
    if variable.n_steps != reference.n_steps:
        return (
            f"{variable.name!r} has {variable.n_steps} steps and {reference.name!r} has "
            f"{reference.n_steps}; the download may be incomplete"
        )
    both = [v.axis().select(F.lit(v.name).alias("variable"), "idx", "days") for v in (variable, reference)]
    found = axes.against_reference(axes.runs(both[0].unionByName(both[1]), ["variable"]), [variable.name], reference.name)
    first = found.first().first_difference
    if first is None:
        return None
    return (
        f"{variable.name!r} covers other days than {reference.name!r}, from index {first} on; the "
        f"download may be incomplete or misordered"
    )
