"""Building stores: raw files to cells, one resumable commit per piece."""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcube.config import GridConfig, described
from gridcube.fs import SharedFs
from gridcube.functions.fixed import (
    BATCH_MESSAGE, BLOCK_MESSAGE, BLOCK_PATTERN, CALENDAR, SKELETON_MESSAGE, TIME_UNITS,
)
from gridcube.functions.grid import block, day_date
from gridcube.operators import axes
from gridcube.plans.store import Store
from gridcube.session import side_by_side
from gridcube.sources.raw import RawVariable, axis_disagreement

LOG = logging.getLogger(__name__)


class Source:
    """One variable's raw data with everything a store records about it."""

    def __init__(self, spark: SparkSession, config: GridConfig, reference: str | None = None):
        self.spark, self.config = spark, config
        self.raw = RawVariable(spark, config, config.variable)
        if reference is not None:
            problem = axis_disagreement(self.raw, RawVariable(spark, config, reference))
            if problem:
                raise ValueError(problem)
        extent = self.raw.extent
        self.sizes = {"time": self.raw.n_steps, "lat": extent["n_lat"], "lon": extent["n_lon"]}
        self.chunks = config.chunks(self.sizes)
        self.strategy = config.strategy(self.chunks, self.sizes)

    def dims(self) -> DataFrame:
        coordinates = [
            self.raw.coordinate(d).select(F.lit(d).alias("dim"), "idx", "value", F.lit(None).cast("long").alias("days"))
            for d in ("lat", "lon")
        ]
        time = self.raw.axis().select(F.lit("time").alias("dim"), "idx", F.lit(None).cast("double").alias("value"), "days")
        return time.unionByName(coordinates[0]).unionByName(coordinates[1])

    def state(self, time_chunk: int) -> dict:
        """What every commit of the store carries besides data."""
        published, upstream = self.raw.attrs
        variable_attrs = self.config.key.variable_attrs(published, self.config.variable)
        ends = self.raw.axis().agg(*_time_coverage(), F.count(F.lit(1)).alias("_n")).first().asDict()
        if (n := ends.pop("_n")) != self.sizes["time"]:
            raise ValueError(f"the first cell of the raw files of {self.raw.name!r} has {n} days, their steps are {self.sizes['time']}: rows or days are missing")
        shape = {f"geospatial_{k}": v for k, v in self.raw.extent.items() if not k.startswith("n_")}
        coverage = {**ends, **shape}
        return {
            "sizes": self.sizes,
            "chunks": self.chunks,
            "variables": {
                self.config.canonical: {
                    "dims": ["time", "lat", "lon"], "dtype": "float32", "fill": "NaN", "attrs": variable_attrs,
                }
            },
            "coordinates": {
                "time": {"chunk": time_chunk, "units": TIME_UNITS, "calendar": CALENDAR, "dtype": "int64"},
                "lat": {"chunk": self.sizes["lat"]},
                "lon": {"chunk": self.sizes["lon"]},
            },
            "attrs": {
                **upstream, **coverage,
                **described(self.config, self.sizes, coverage, variable_attrs),
                **self.config.attrs(),
            },
        }


def _time_coverage() -> list:
    return [
        F.date_format(day_date(F.min("days")), "yyyy-MM-dd").alias("time_coverage_start"),
        F.date_format(day_date(F.max("days")), "yyyy-MM-dd").alias("time_coverage_end"),
        F.lit("P1D").alias("time_coverage_resolution"),
    ]


def derived_attrs(dims: DataFrame) -> dict:
    """Coverage and grid attributes of a store, read off its axes."""
    def axis(dim, test):
        return F.when((F.col("dim") == dim) & test, F.col("value"))

    anywhere = F.lit(True)
    aggregates = _time_coverage()
    for dim in ("lat", "lon"):
        step = F.max(axis(dim, F.col("idx") == 1)) - F.max(axis(dim, F.col("idx") == 0))
        aggregates += [
            F.round(F.min(axis(dim, anywhere)), 4).alias(f"geospatial_{dim}_min"),
            F.round(F.max(axis(dim, anywhere)), 4).alias(f"geospatial_{dim}_max"),
            F.round(F.abs(step), 4).alias(f"geospatial_{dim}_resolution"),
        ]
    return dims.agg(*aggregates).first().asDict()


def differing_labels(stored: DataFrame, wanted: DataFrame, label: str) -> bool:
    """Whether two (idx, label) tables differ anywhere. Days are compared by their runs."""
    if label == "days":
        return not axes.unlike_runs(stored, wanted).isEmpty()
    other = wanted.select("idx", F.col(label).alias("_want"), F.lit(True).alias("_there"))
    rows = stored.withColumn("_here", F.lit(True)).join(other, "idx", "full_outer")
    wrong = F.col("_here").isNull() | F.col("_there").isNull() | ~F.col(label).eqNullSafe(F.col("_want"))
    return not rows.where(wrong).isEmpty()


def _check_variables(store: Store, source: Source) -> None:
    found, expected = set(store.state()["variables"]), {source.config.canonical}
    if found != expected:
        raise ValueError(
            f"the store holds {sorted(found)}, this run would write {sorted(expected)}; delete the store to rebuild it"
        )


def build_append(store: Store, source: Source) -> int:
    """Batches of time steps, each its own commit. Resumes after the last one.

    Raw is read once for ``batches_per_pass`` batches, all that are missing unless set. Raw rows arrive in (t, i, j)
    order, which is also the order of this layout, so a pass is a scan, a sort within tasks and a write, without
    a shuffle. Batches of a pass are written together and committed one by one, so that a run that ends in between
    resumes behind the last commit.
    """
    n_time = source.sizes["time"]
    batch = source.config.batch_steps(source.chunks)
    done = (store.state().get("sizes") or {}).get("time", 0)
    if done:
        _check_variables(store, source)
        overlap = source.raw.axis().where(F.col("idx") < done)
        if differing_labels(store.axis(), overlap, "days"):
            raise ValueError("the time steps in the store are not those of the input; delete the store to rebuild it")
        if done >= n_time:
            LOG.info("the store is complete, nothing to write")
            return 0
        if done % batch:
            raise ValueError(f"the store holds {done} steps, not a whole number of batches of {batch}; delete it to rebuild")
        LOG.info("resuming from step %d", done)
    state = source.state(batch)
    spans = [(first, min(first + batch, n_time)) for first in range(done, n_time, batch)]
    at_once = source.config.settings.get("batches_per_pass") or len(spans)
    for k in range(0, len(spans), at_once):
        _extend(store, source, state, spans[k : k + at_once], batch)
    return len(spans)


def _extend(store: Store, source: Source, state: dict, spans: list[tuple[int, int]], batch: int) -> None:
    """Some batches of an append store: one scan of raw, one write, a commit each."""
    n_time, begin = source.sizes["time"], spans[0][0]
    cells = source.raw.valid_cells(steps=(begin, spans[-1][1])).withColumn("part", block(F.col("t") - begin, batch))
    cells = cells.sortWithinPartitions("part", "t", "i", "j")
    for snapshot, (first, last) in zip(store.write_parts(cells, len(spans), source.chunks), spans):
        work = store.begin(snapshot)
        work.state = {**state, "sizes": {**source.sizes, "time": last}, "axis_written": n_time}
        work.take_over({"t": (first, last), "i": (0, source.sizes["lat"]), "j": (0, source.sizes["lon"])})
        # the axes are written ahead, once; the recorded size says how far they count
        known = work.parent_state.get("axis_written", 0)
        if known < n_time:
            fresh = (F.col("dim") == "time") & (F.col("idx") >= known)
            work.write_dims(source.dims().where(fresh if known else fresh | (F.col("dim") != "time")))
        work.commit(BATCH_MESSAGE.format(first=first, last=last - 1))


def committed_blocks(store: Store) -> set[tuple[int, int, int, int]]:
    """Blocks written so far, read back from the commit messages."""
    found = (re.match(BLOCK_PATTERN, c.message) for c in store.ancestry())
    return {tuple(int(v) for v in m.groups()[1:]) for m in found if m}


def build_region(store: Store, source: Source) -> int:
    """A skeleton of axes and attributes, then one commit per block of whole series.

    Raw is read once for ``blocks_per_pass`` blocks, all that are missing unless set. Their rows are
    shuffled once, by tile, and rebalanced: small partitions are joined and large ones split to one file size,
    however the land lies. Blocks of a pass are written together and committed one by one, so that a run
    that ends in between resumes behind the last commit.
    """
    wanted = source.config.blocks(source.chunks, source.sizes)
    if store.state().get("variables"):
        _check_variables(store, source)
        pairs = [("time", store.axis(), source.raw.axis(), "days")]
        pairs += [(d, store.coordinate(d), source.raw.coordinate(d), "value") for d in ("lat", "lon")]
        for dim, stored, expected, label in pairs:
            if differing_labels(stored, expected, label):
                raise ValueError(f"the {dim} axis in the store is not that of the input; delete the store to rebuild it")
        if store.state()["chunks"] != source.chunks:
            raise ValueError(
                f"the store is chunked {store.state()['chunks']}, this run would write {source.chunks}; delete the store to rebuild it"
            )
        done = committed_blocks(store)
        stray = done - set(wanted)
        if stray:
            LOG.warning("%d committed blocks do not match the block shape and are redone", len(stray))
    else:
        skeleton = store.begin()
        skeleton.state = source.state(source.sizes["time"])
        skeleton.write_dims(source.dims())
        skeleton.commit(SKELETON_MESSAGE)
        done = set()
    remaining = [b for b in wanted if b not in done]
    if not remaining:
        LOG.info("the store is complete, nothing to write")
    at_once = source.config.settings.get("blocks_per_pass") or len(remaining)
    for first in range(0, len(remaining), at_once or 1):
        _fill(store, source, wanted, remaining[first : first + at_once])
    return len(remaining)


def blocks_of(raw: DataFrame, grid: list[tuple[int, int, int, int]], blocks: list[tuple[int, int, int, int]]) -> DataFrame:
    """Cells of some of the grid's blocks, ``part`` being the place of a cell's block among them."""
    high, wide = (max(b[k + 1] - b[k] for b in grid) for k in (0, 2))
    columns = max(b[2] for b in grid) // wide + 1
    part_of = [-1] * (columns * (max(b[0] for b in grid) // high + 1))
    for part, (i0, _, j0, _) in enumerate(blocks):
        part_of[i0 // high * columns + j0 // wide] = part
    place = block(F.col("i"), high) * columns + block(F.col("j"), wide)
    return raw.withColumn("part", F.get(F.array(*map(F.lit, part_of)), place.cast("int"))).where("part >= 0")


def _fill(store: Store, source: Source, grid: list, blocks: list) -> None:
    """Some blocks of a region store: one scan of raw, one shuffle, one write, a commit each."""
    ends = [(min(b[k] for b in blocks), max(b[k + 1] for b in blocks)) for k in (0, 2)]
    cells = blocks_of(source.raw.valid_cells(i=ends[0], j=ends[1]), grid, blocks).select(
        "*", block(F.col("i"), source.chunks["lat"]).alias("ci"), block(F.col("j"), source.chunks["lon"]).alias("cj")
    )
    cells = cells.hint("rebalance", "part", "ci", "cj").sortWithinPartitions("part", "ci", "cj", "i", "j", "t")
    for snapshot, (i0, i1, j0, j1) in zip(store.write_parts(cells, len(blocks), source.chunks), blocks):
        work = store.begin(snapshot)
        work.take_over({"t": (0, source.sizes["time"]), "i": (i0, i1), "j": (j0, j1)})
        work.commit(BLOCK_MESSAGE.format(variable=source.config.canonical, i0=i0, i1=i1, j0=j0, j1=j1))


def check_unpublished(store: Store, force: bool) -> None:
    """A tagged store is published. Rebuilding it needs to be asked for."""
    tags = sorted(store.tags())
    if not tags:
        return
    if not force:
        raise ValueError(f"{store.path} is published as {tags}; force a rebuild, or delete the store first")
    LOG.warning("%s is published as %s and is rebuilt anyway; verify and tag it again", store.path, tags)


def build_store(spark: SparkSession, config: GridConfig, reference: str | None = None, force: bool = False) -> int:
    """Build or resume the store of one variable. Returns the commits made."""
    source = Source(spark, config, reference)
    store = Store.open_or_create(spark, config.store_path)
    check_unpublished(store, force)
    write = build_append if source.strategy == "append" else build_region
    return write(store, source)


def build_family(spark: SparkSession, config: GridConfig, variable: str | None = None, force: bool = False) -> dict[str, int]:
    """Every store of the layout, or the one named in either spelling.

    Stores do not depend on one another, so several are built at a time: their jobs
    share the cluster, which one store's last tasks alone would leave idle.
    """
    family = config.family(SharedFs(spark, config.raw_dir))
    names = [config.key.resolve(variable, family)] if variable else family
    one = lambda name: build_store(spark, config.of(name), family[0], force)
    return dict(zip(names, side_by_side(one, names, config.settings.get("num_workers"))))
