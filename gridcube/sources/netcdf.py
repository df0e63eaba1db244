"""netCDF source files as a Spark data source.

One input partition per (file, slab of time steps), so a file is read by as many
tasks as it has slabs and no task holds more than one slab. With the option
``header`` only the time axis of each file is read, and no data. Filters on ``local_t``,
``i`` and ``j`` shrink the hyperslabs where Spark pushes them down. Masking and
scaling stay off: the sentinel arrives as the file holds it.

Needs ``netCDF4`` on the executors, or any opener named by the ``opener`` option as
``module:function``: a function of a path that returns a context manager with
``variables[name][slices]``, ``attrs(name)`` and ``attrs()``.
"""

from __future__ import annotations

import contextlib
import importlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    In,
    DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition,
    LessThan, LessThanOrEqual,
)

COLUMNS = (
    "local_t INT, days BIGINT, i INT, j INT, lat DOUBLE, lon DOUBLE, value FLOAT, file STRING"
)
NAMES = ["local_t", "days", "i", "j", "lat", "lon", "value", "file"]
BATCH_ROWS = 262_144
DEFAULT_OPENER = "gridcube.sources.netcdf:open_netcdf"


class _NetcdfFile:
    def __init__(self, dataset):
        self._dataset = dataset
        self.variables = dataset.variables

    def attrs(self, name: str | None = None) -> dict:
        holder = self._dataset.variables[name] if name else self._dataset
        return {k: holder.getncattr(k) for k in holder.ncattrs() if k != "_FillValue"}


@contextlib.contextmanager
def open_netcdf(path: str):
    try:
        import netCDF4
    except ImportError as missing:
        raise ImportError("reading netCDF files needs the netCDF4 package") from missing
    dataset = netCDF4.Dataset(path)
    dataset.set_auto_maskandscale(False)
    try:
        yield _NetcdfFile(dataset)
    finally:
        dataset.close()


def _opener(name: str):
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


@dataclass
class Share(InputPartition):
    """Every ``of``-th slab of a file, from the ``k``-th on. How many there are is for the task
    that opens the file to find out."""

    path: str
    k: int
    of: int


class NetcdfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"])
        self.variable = options["variable"]
        self.steps = int(options.get("slab", "12"))
        self.opener = options.get("opener", DEFAULT_OPENER)
        self.header = options.get("header", "false") == "true"
        self.shares = int(options.get("shares", "8"))
        self.bounds = {"local_t": [0, None], "i": [0, None], "j": [0, None]}
        self.only: set[int] | None = None  # single steps asked for

    def pushFilters(self, filters):
        """Narrow the hyperslab; every filter is still applied by Spark afterwards."""
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) else None
            if column in self.bounds and len(f.attribute) == 1:
                low, high = self.bounds[column]
                if isinstance(f, In):
                    wanted = {v for v in f.value if v is not None}
                    low, above = max([low, *([min(wanted)] if wanted else [])]), max(wanted, default=-1) + 1
                    high = above if high is None else min(high, above)
                    if column == "local_t":
                        self.only = wanted if self.only is None else self.only & wanted
                elif isinstance(f, (EqualTo, GreaterThanOrEqual)):
                    low = max(low, f.value)
                elif isinstance(f, GreaterThan):
                    low = max(low, f.value + 1)
                above = None
                if isinstance(f, (EqualTo, LessThanOrEqual)):
                    above = f.value + 1
                elif isinstance(f, LessThan):
                    above = f.value
                if above is not None:
                    high = above if high is None else min(high, above)
                self.bounds[column] = [low, high]
            yield f

    def partitions(self):
        return [Share(path, k, self.shares) for path in self.paths for k in range(1 if self.header else self.shares)]

    def slabs(self, share: Share, n: int) -> list[tuple[int, int]]:
        """Step ranges of a share in a file of n steps, without those that hold no wanted step."""
        low, high = self.bounds["local_t"]
        end = n if high is None else min(n, high)
        found = [(a, min(a + self.steps, end)) for a in range(low + share.k * self.steps, end, share.of * self.steps)]
        return [s for s in found if self.only is None or any(s[0] <= t < s[1] for t in self.only)]

    def read(self, partition):
        import numpy as np
        import pyarrow as pa

        name = partition.path.rsplit("/", 1)[1]
        with _opener(self.opener)(partition.path) as held:
            if self.header:
                days = np.asarray(held.variables["time"][:]).astype("int64")
                n = len(days)
                empty = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(n, dtype="int32")), pa.array(days), *empty, pa.repeat(name, n)], names=NAMES
                )
                return
            lat, lon = held.variables["lat"], held.variables["lon"]
            rows = range(lat.shape[0])[slice(*self.bounds["i"])]
            cols = range(lon.shape[0])[slice(*self.bounds["j"])]
            where = (slice(rows.start, rows.stop), slice(cols.start, cols.stop))
            lats, lons = np.asarray(lat[where[0]], "float64"), np.asarray(lon[where[1]], "float64")
            j = np.arange(cols.start, cols.stop, dtype="int32")
            height = max(1, BATCH_ROWS // max(1, len(cols)))
            for first, last in self.slabs(partition, held.variables["time"].shape[0]):
                days = np.asarray(held.variables["time"][first:last]).astype("int64")
                # one read per slab: a compressed source chunk spans several steps, and reading
                # step by step would decompress it once per step
                slab = np.asarray(held.variables[self.variable][first:last, where[0], where[1]], "float32")
                for k, day in enumerate(days):
                    for top in range(0, len(rows), height):
                        part = slab[k, top:top + height]
                        n = part.size
                        i = np.arange(rows.start + top, rows.start + top + len(part), dtype="int32")
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, first + k, "int32")), pa.array(np.full(n, day, "int64")),
                                pa.array(np.repeat(i, len(cols))), pa.array(np.tile(j, len(part))),
                                pa.array(np.repeat(lats[top:top + height], len(cols))), pa.array(np.tile(lons, len(part))),
                                pa.array(part.ravel()), pa.repeat(name, n),
                            ],
                            names=NAMES,
                        )


class NetcdfSource(DataSource):
    @classmethod
    def name(cls):
        return "grid_netcdf"

    def schema(self):
        return COLUMNS

    def reader(self, schema):
        return NetcdfReader(dict(self.options))


def read_netcdf(spark: SparkSession, files: list[str], variable: str, **options) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NetcdfSource)
    reader = spark.read.format("grid_netcdf").option("paths", json.dumps(files)).option("variable", variable)
    return reader.options(**options).load()


def read_attrs(path: str, variable: str, opener: str = DEFAULT_OPENER) -> tuple[dict, dict]:
    with _opener(opener)(path) as held:
        return held.attrs(variable), held.attrs()
