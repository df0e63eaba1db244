"""Whole runs over the event grid: raw files, stores in both layouts, audit, stream.

Each query writes a raw tree and stores below the shared folder, from all rows of
the table, then reads back what the run is about.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce as fold

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcube.catalog.registry import query
from gridcube.config import GridConfig
from gridcube.cube import Cube, inventory
from gridcube.fs import SharedFs
from gridcube.functions.grid import day_number
from gridcube.functions.names import NameKey
from gridcube.operators import chunks
from gridcube.plans import finalize
from gridcube.plans.build import build_family
from gridcube.plans.store import AXES, Store
from gridcube.plans.verify import DEFAULT_PHASES, Audit
from gridcube.session import cut_lineage, fresh_dir, side_by_side
from gridcube.sources.raw import ATTRS_FILE, SCHEMA, RawVariable
from gridcube.sources.tables import EVENT_START, EVENTS_SQL, N_LAT, event_cells, lat_of, lon_of, table
from gridcube.streaming.append import append_stream

KEY = NameKey("""
| original_variable_name | canonical_name | canonical_units | canonical_long_name | unit_conversion |
| --- | --- | --- | --- | --- |
| click | clicks | W m-2 | value of clicks | none |
| error | errors | W m-2 | value of errors | none |
| purchase | purchases | W m-2 | value of purchases | none |
| signup | signups | W m-2 | value of signups | none |
| view | views | W m-2 | value of views | none |

| original_frequency_name | canonical_name | canonical_long_name |
| --- | --- | --- |
| daily | day | daily total |
""")
DAYS_PER_FILE = 10

# The stores' time axis runs from the first day with data to the last.
SPAN_SQL = EVENTS_SQL + """, span AS (SELECT min(t) AS t0, max(t) - min(t) + 1 AS n_days, (max(t) - min(t)) // 10 + 1 AS n_batches FROM cells)"""
STORED_SQL = SPAN_SQL + """, stored AS (SELECT CASE variable WHEN 'purchase' THEN 'purchases' ELSE variable || 's' END AS variable,
      t - t0 AS t, i, j, CAST(CAST(cents / 100.0 AS FLOAT) AS DOUBLE) AS value FROM cells, span WHERE cents % 7 <> 0)"""


BLOCK_COLUMNS = 512  # so many columns of a grid row are packed together
FILE_CELLS = 1_000_000  # a raw data file holds no more cells, but for one row of a plane
TASK_CELLS = 250_000  # a task fills about so many


def raw_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Every cell of the event grid, the sentinel where there is no data.

    Rows of the grid are filled last: up to then only cells with data travel, packed by stretches of columns. Tasks
    get pieces of a raw file, some days or, where a plane is large, some rows of one, and fill those.
    """
    east = F.expr(f"user_id div {N_LAT}")
    events = table(spark, folder, "events").select(F.to_date("ts").alias("date"), east.alias("j"), F.col("event_type").alias("variable"))
    ends = events.agg(F.min("date").alias("first"), F.max("date").alias("last"), F.max("j").alias("east"), F.count_distinct("variable").alias("n")).first()
    start = dt.date.fromisoformat(EVENT_START)
    first, last = (ends.first - start).days, (ends.last - start).days
    plane = N_LAT * (ends.east + 1)
    days, rows = max(1, min(DAYS_PER_FILE, FILE_CELLS // plane)), max(1, min(N_LAT, FILE_CELLS // (ends.east + 1)))

    cells = event_cells(spark, folder).withColumn("block", F.floor(F.col("j") / BLOCK_COLUMNS))
    held = cells.groupBy("variable", "t", "i", "block").agg(F.collect_list(F.struct("j", "cents")).alias("held"))
    spelled = lambda a, b, name: F.explode(F.sequence(F.lit(a).cast("long"), F.lit(b).cast("long"))).alias(name)
    planes = events.select("variable").distinct().select("variable", spelled(first, last, "t")).select("*", spelled(0, N_LAT - 1, "i"))
    wanted = planes.select("*", spelled(0, ends.east // BLOCK_COLUMNS, "block"))
    step = F.col("t") - first
    packed = wanted.join(held, ["variable", "t", "i", "block"], "left").select(
        "*", F.floor(step / DAYS_PER_FILE).cast("int").alias("part"), (step % DAYS_PER_FILE).cast("int").alias("local_t"),
    ).repartition(
        max(1, -(-plane * (last - first + 1) * ends.n // TASK_CELLS)),
        "variable", "part", F.floor(F.col("local_t") / days), F.floor(F.col("i") / rows),
    )
    low = F.col("block") * BLOCK_COLUMNS
    columns = F.sequence(low, F.least(low + (BLOCK_COLUMNS - 1), F.lit(ends.east)))
    empty = lambda found: F.transform(found, lambda j: F.struct(j.alias("j"), F.lit(None).cast("long").alias("cents")))
    every = F.when(F.col("held").isNull(), empty(columns)).otherwise(
        F.concat("held", empty(F.array_except(columns, F.transform("held", lambda cell: cell["j"])))))
    filled = packed.select("variable", "local_t", "t", "i", "part", F.inline(every))
    value = F.when(F.col("cents") % 7 != 0, F.col("cents") / 100).otherwise(-999.0).cast("float")
    return filled.select(
        "variable", "local_t", (day_number(F.lit(EVENT_START).cast("date")) + F.col("t")).alias("days"),
        F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"),
        lat_of(F.col("i")).alias("lat"), lon_of(F.col("j")).alias("lon"), value.alias("value"), "part",
    )


def config_of(raw: str, root: str, layout: str) -> GridConfig:
    spatial = layout == "spatial"
    return GridConfig(
        {
            "directories": {"raw": raw, "download": root}, "dataset": "events", "version": "v1.0a", "variables": "all",
            "output_conventions": {"filename": "{suffix}/events.{version}.{temporal_frequency}.{variable}", "suffix": layout},
            "temporal_resolution": "daily", "timesteps_per_commit": 10,
            "chunks": {"time": 1, "lat": -1, "lon": -1} if spatial else {"time": -1, "lat": 6, "lon": 1},
            "write_strategy": "append" if spatial else "region",
            "block_shape": {"lat": 18, "lon": -1},
            "attrs": {"source": "table events, {original_variable}"},
        },
        KEY,
    )


# Raw trees and finished stores of this session, by the state of the input. Queries that
# only read share them; a query that moves a branch builds stores of its own.
_MADE: dict[tuple, str] = {}


def _stamp(spark: SparkSession, folder: str) -> tuple:
    """Names, times and sizes of the files that hold the events."""
    fs, table = SharedFs(spark, folder), f"{folder.rstrip('/')}/events.parquet"
    return (*fs.list(table), *fs.size(table))


def _once(spark: SparkSession, folder: str, what: str, make) -> str:
    key = (spark.sparkContext.applicationId, folder, _stamp(spark, folder), what)
    if key not in _MADE or not SharedFs(spark, _MADE[key]).exists(_MADE[key]):
        root = fresh_dir(spark, f"events-{what}")
        make(root)
        _MADE[key] = root
    return _MADE[key]


def _write_raw(spark: SparkSession, folder: str, root: str) -> None:
    target = config_of(root, root, "spatial").raw_dir
    fs, staged = SharedFs(spark, root), f"{root}/staged"
    rows = raw_grid(spark, folder).sortWithinPartitions("variable", "part", "local_t", "i", "j")
    rows.write.partitionBy("variable", "part").parquet(staged)
    for variable, is_folder, _ in fs.list(staged):
        for part, _, _ in fs.list(f"{staged}/{variable}") if is_folder else ():
            name, number = variable.partition("=")[2], int(part.partition("=")[2])
            fs.move(f"{staged}/{variable}/{part}", f"{target}/{name}/{name}_{number:06d}.parquet")
    for name in KEY.variables:
        attrs = {"variable": {"standard_name": name, "long_name": f"{name} value", "units": "W.m-2"}, "global": {}}
        fs.write_new(f"{target}/{name}/{ATTRS_FILE}", json.dumps(attrs))


def built(spark: SparkSession, folder: str, *layouts: str, own: bool = False) -> list[GridConfig]:
    """Configurations of finished stores, one per layout."""
    raw = _once(spark, folder, "raw", lambda root: _write_raw(spark, folder, root))
    make = lambda root, layout: build_family(spark, config_of(raw, root, layout))
    configs = []
    for layout in layouts:
        if own:
            root = fresh_dir(spark, f"events-own-{layout}")
            make(root, layout)
        else:
            root = _once(spark, folder, layout, lambda root, layout=layout: make(root, layout))
        configs.append(config_of(raw, root, layout))
    return configs


def _read_back(spark: SparkSession, config: GridConfig, ref: str = "main") -> DataFrame:
    cells = Cube.open(spark, config, list(KEY.variables), ref).cells(labels=False)
    return cells.withColumn("value", F.col("value").cast("double"))


@query("K1 K2 K7 K9 K10 S5 S11 S14 U6 R2", f"WITH {STORED_SQL} SELECT variable, t, i, j, value FROM stored")
def append_store(spark, folder):
    """All variables built batch by batch, read back."""
    (config,) = built(spark, folder, "spatial")
    return _read_back(spark, config)


@query("K3 K4 K5 K6 P11 S11 S15", f"WITH {STORED_SQL} SELECT variable, t, i, j, value FROM stored")
def region_store(spark, folder):
    """All variables built block by block as series, read back."""
    (config,) = built(spark, folder, "temporal")
    return _read_back(spark, config)


@query("K2 K5 R3 R4 R5 R9 J12", f"""WITH {STORED_SQL} SELECT variable, layout, count(*) AS n_cells, round(sum(value), 2) AS total
    FROM stored, (VALUES ('spatial'), ('temporal')) l(layout) GROUP BY 1, 2""")
def resumed_stores(spark, folder):
    """Both layouts rolled back to an earlier commit and built again: nothing is lost or doubled."""
    configs = built(spark, folder, "spatial", "temporal", own=True)
    out = []
    for config in configs:
        for name in KEY.variables:
            store = Store.open(spark, config.of(name).store_path)
            store.reset(store.ancestry()[1].id)
        build_family(spark, config)
        layout = config.settings["output_conventions"]["suffix"]
        out.append(_read_back(spark, config).withColumn("layout", F.lit(layout)))
    return fold(DataFrame.unionByName, out).groupBy("variable", "layout").agg(
        F.count(F.lit(1)).alias("n_cells"), F.round(F.sum("value"), 2).alias("total")
    )


@query("S19 K12 R9", f"""WITH {STORED_SQL} SELECT 'tag' AS ref, variable, t, i, j, value FROM stored
    UNION ALL SELECT 'main', variable, t, i, j, value FROM stored, span WHERE t < (n_batches - 1) * 10""")
def tagged_read(spark, folder):
    """A tag keeps showing what it named while the branch moves."""
    (config,) = built(spark, folder, "spatial", own=True)
    for name in KEY.variables:
        store = Store.open(spark, config.of(name).store_path)
        store.tag("v1")
        store.reset(store.ancestry()[1].id)
    tip, tagged = _read_back(spark, config), _read_back(spark, config, "v1")
    return tagged.withColumn("ref", F.lit("tag")).unionByName(tip.withColumn("ref", F.lit("main")))


@query("S16 S17 S18 A19", f"""WITH {STORED_SQL} SELECT variable, CAST(0 AS BIGINT) AS ct, i // 6 AS ci, j AS cj, count(*) AS n_valid, count(*) * 4 AS nbytes
    FROM stored GROUP BY variable, i // 6, j""")
def store_manifest(spark, folder):
    (config,) = built(spark, folder, "temporal")
    tables = [
        Store.open(spark, config.of(n).store_path).manifest().select(F.lit(KEY.canonical(n)).alias("variable"), "ct", "ci", "cj", "n_valid", "nbytes")
        for n in KEY.variables
    ]
    return fold(DataFrame.unionByName, tables)


CHUNKED_SQL = STORED_SQL + """, chunked AS (
      SELECT variable, 'spatial' AS layout, t, i, j, t AS ct, CAST(0 AS BIGINT) AS ci, CAST(0 AS BIGINT) AS cj FROM stored
      UNION ALL SELECT variable, 'temporal', t, i, j, CAST(0 AS BIGINT), i // 6, j FROM stored)"""


def _layouts(spark, folder):
    """(variable, layout, store, raw, chunks) of every store in both layouts."""
    for config in built(spark, folder, "spatial", "temporal"):
        for name in KEY.variables:
            store = Store.open(spark, config.of(name).store_path)
            yield KEY.canonical(name), config.settings["output_conventions"]["suffix"], store, RawVariable(spark, config, name), store.state()["chunks"]


@query("S17 V4 V5 J2", f"""WITH {CHUNKED_SQL}
    SELECT variable, layout, ct, ci, cj, count(*) AS n_valid, count(*) AS n_raw, true AS as_raw FROM chunked GROUP BY ALL""")
def chunk_digests(spark, folder):
    """Every chunk of every store against raw, by the digests in the chunk tables: no cell of a store is read."""
    tables = []
    for variable, layout, store, raw, sizes in _layouts(spark, folder):
        theirs = chunks.manifest(raw.valid_cells(), [], sizes, digest=True).select(*chunks.CHUNK, *(F.col(c).alias(f"raw_{c}") for c in ("n_valid", *chunks.DIGEST)))
        same = fold(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"raw_{c}")) for c in chunks.DIGEST))
        zero = F.lit(0).cast("long")
        tables.append(store.manifest().join(theirs, list(chunks.CHUNK), "full_outer").select(
            F.lit(variable).alias("variable"), F.lit(layout).alias("layout"), *chunks.CHUNK,
            F.coalesce("n_valid", zero).alias("n_valid"), F.coalesce("raw_n_valid", zero).alias("n_raw"), same.alias("as_raw")))
    return fold(DataFrame.unionByName, tables)


@query("S17 V5 J2 J10", f"""WITH {CHUNKED_SQL}, ends AS (SELECT variable, layout, min((t, i, j)) AS first, max((t, i, j)) AS last FROM chunked GROUP BY 1, 2)
    SELECT variable, layout, ct, ci, cj, count(*) - count(*) FILTER (WHERE (t, i, j) = first) AS n_left, count(*) AS n_right
    FROM chunked JOIN ends USING (variable, layout) GROUP BY 1, 2, 3, 4, 5
    HAVING bool_or((t, i, j) = first OR (t, i, j) = last)""")
def changed_chunks(spark, folder):
    """Each store's first cell taken away and its last one changed in the last bit of its value: the chunks whose
    cells no longer are those recorded, found without a cell of the record."""
    tables = []
    for variable, layout, store, _, sizes in _layouts(spark, folder):
        place = F.struct("t", "i", "j")
        ends = store.cells().agg(F.min(place).alias("first"), F.max(place).alias("last")).first()
        at = lambda end: fold(lambda a, b: a & b, (F.col(x) == end[x] for x in ("t", "i", "j")))
        # multiplied by a hair more than one, a float becomes the next one
        nudged = F.when(at(ends.last), (F.col("value").cast("double") * (1 + 2.0**-23)).cast("float")).otherwise(F.col("value"))
        cells = store.cells().where(~at(ends.first)).withColumn("value", nudged)
        found = chunks.unlike(chunks.manifest(cells, [], sizes, digest=True), store.manifest())
        tables.append(found.select(F.lit(variable).alias("variable"), F.lit(layout).alias("layout"), *chunks.CHUNK, "n_left", "n_right"))
    return fold(DataFrame.unionByName, tables)


@query("S6 S9 S10 V5 K1", f"""WITH {STORED_SQL}
    SELECT variable, t // 10 AS batch, count(*) AS n_rows, min(t) AS t_low, max(t) AS t_high, min(i) AS i_low, max(i) AS i_high, min(j) AS j_low, max(j) AS j_high
    FROM stored GROUP BY 1, 2""")
def commit_footers(spark, folder):
    """What each commit's files say of themselves in their footers: rows and extremes, no cell read."""
    (config,) = built(spark, folder, "spatial")
    tables = []
    for name in KEY.variables:
        store = Store.open(spark, config.of(name).store_path)
        first = spark.createDataFrame([(c.id, c.box["t"][0]) for c in store.ancestry() if c.box], "snapshot string, first int")  # a row per commit
        ends = [F.col("extremes")[x][end].alias(f"{x}_{end}") for x in AXES for end in ("low", "high")]
        files = store.files(store.data_folders()).where("n_rows > 0").select("snapshot", "n_rows", *ends)
        tables.append(files.join(first, "snapshot").groupBy(F.floor(F.col("first") / 10).alias("batch")).agg(
            F.sum("n_rows").alias("n_rows"), *(F.min(f"{x}_low").alias(f"{x}_low") for x in AXES), *(F.max(f"{x}_high").alias(f"{x}_high") for x in AXES),
        ).withColumn("variable", F.lit(KEY.canonical(name))))
    return fold(DataFrame.unionByName, tables)


@query("R1 R2 R3 X15", f"""WITH {SPAN_SQL}, v AS (SELECT DISTINCT variable FROM cells),
      k AS (SELECT n_days, n_batches, unnest(range(n_batches)) AS k FROM span)
    SELECT variable, n_batches AS depth, 'repository initialized' AS message FROM v, span
    UNION ALL SELECT variable, n_batches - 1 - k, format('write timesteps {{}}-{{}}', k * 10, least(k * 10 + 9, n_days - 1)) FROM v, k""")
def commit_history(spark, folder):
    (config,) = built(spark, folder, "spatial")
    tables = [
        Store.open(spark, config.of(n).store_path).commits_table().select(F.lit(n).alias("variable"), "depth", "message")
        for n in KEY.variables
    ]
    return fold(DataFrame.unionByName, tables)


@query("X2 X3 X4 X5 X9 A16 S1", f"""WITH {EVENTS_SQL}, c AS (SELECT variable, CASE WHEN variable = 'purchase' THEN 'purchases' ELSE variable || 's' END AS name,
      (SELECT year(min(date)) FROM cells) AS a, (SELECT year(max(date)) FROM cells) AS b FROM cells GROUP BY 1)
    SELECT name AS variable, format('Value of {{0}} [{{0}}], events v1.0a, {{1}} to {{2}}, every 5 degrees, laid out for whole maps', name, a, b) AS title,
      format('spatial/events.v_1_0_a.day.{{}}', name) AS filename, format('table events, {{}}', variable) AS source FROM c""")
def store_titles(spark, folder):
    """What each store says of itself: derived title, rendered filename and attribute."""
    (config,) = built(spark, folder, "spatial")
    rows = []
    for name in KEY.variables:
        own = config.of(name)
        attrs = Store.open(spark, own.store_path).state()["attrs"]
        rows.append((own.canonical, attrs["title"], own.store_path.split("/stores/")[1], attrs["source"]))
    return spark.createDataFrame(rows, "variable string, title string, filename string, source string")


@query("X6 X7 X8 S13 S23 S24 S25 S26 R6 U5", """WITH v AS (SELECT DISTINCT event_type AS o, CASE WHEN event_type = 'purchase' THEN 'purchases' ELSE event_type || 's' END AS c FROM events),
    a AS (SELECT o, c, unnest(['standard_name', 'long_name', 'units', 'original_variable_name', 'original_standard_name', 'original_long_name', 'original_units', 'unit_conversion']) AS key FROM v)
    SELECT c AS owner, key, CASE key WHEN 'standard_name' THEN c WHEN 'long_name' THEN 'value of ' || c WHEN 'units' THEN 'W m-2'
      WHEN 'original_variable_name' THEN o WHEN 'original_standard_name' THEN o WHEN 'original_long_name' THEN o || ' value' WHEN 'original_units' THEN 'W.m-2'
      ELSE 'none; ''W.m-2'' is spelled ''W m-2'' here, values are as published' END AS value FROM a""")
def variable_attrs(spark, folder):
    """The attributes each stored variable carries, as a table."""
    (config,) = built(spark, folder, "spatial")
    rows = []
    for name in KEY.variables:
        held = Store.open(spark, config.of(name).store_path).state()["variables"]
        rows += [(owner, key, str(value)) for owner, v in held.items() for key, value in v["attrs"].items()]
    return spark.createDataFrame(rows, "owner string, key string, value string")


@query("S12 S13 S20 J1 J6 J17 A2 P3 P4", f"""WITH {STORED_SQL} SELECT variable, DATE '{EVENT_START}' + CAST(t + t0 AS INTEGER) AS date,
      round(sum(value * cos(radians(87.5 - 5.0 * i))) / sum(cos(radians(87.5 - 5.0 * i))), 4) AS land_mean
    FROM stored, span WHERE t + t0 BETWEEN 4 AND 14 AND 87.5 - 5.0 * i BETWEEN 22 AND 52 GROUP BY 1, 2""")
def cube_series(spark, folder):
    """A regional daily series off the stores, selected by label."""
    (config,) = built(spark, folder, "spatial")
    cube = Cube.open(spark, config, ["views", "click", "errors", "signup", "purchase"])
    means = cube.sel(time=("2024-01-05", "2024-01-15"), lat=(52, 22)).land_mean(["variable", "date"])
    return means.select("variable", "date", F.round("land_mean", 4).alias("land_mean"))


@query("S21 A18", f"""WITH {SPAN_SQL} SELECT variable AS original, 'W m-2' AS units, 'W.m-2' AS original_units,
      CAST((SELECT n_days FROM span) * 36 * ((SELECT max(j) FROM cells) + 1) * 4 AS DOUBLE) / 1073741824 AS gib FROM cells GROUP BY 1""")
def store_inventory(spark, folder):
    (config,) = built(spark, folder, "spatial")
    return inventory(spark, config).select("original", "units", "original_units", "gib")


@query("V1 V2 V3 V4 V5 V6 V8 V9 V10 V11 A20 S8 S10 R10 K14", """SELECT DISTINCT event_type AS variable, layout, phase, true AS tested, CAST(0 AS BIGINT) AS n_failed
    FROM events, (VALUES ('spatial'), ('temporal')) l(layout),
      (VALUES ('structure'), ('index'), ('samples'), ('sweep'), ('ranges'), ('metadata')) p(phase)""")
def verified_stores(spark, folder):
    """Failures per variable, layout and phase, over stores built from the table: none."""
    spatial, temporal = built(spark, folder, "spatial", "temporal")
    pairs = [(c, o, n) for c, o in ((spatial, temporal), (temporal, spatial)) for n in KEY.variables]

    def audited(pair):
        config, other, name = pair
        audit = Audit(spark, config.of(name), other)
        audit.run((*DEFAULT_PHASES, "metadata"))
        layout = config.settings["output_conventions"]["suffix"]
        return [(name, layout, *check) for check in audit.checks]

    checks = [row for rows in side_by_side(audited, pairs) for row in rows]
    schema = "variable string, layout string, phase string, label string, ok boolean, detail string"
    report = spark.createDataFrame(checks, schema)
    return report.groupBy("variable", "layout", "phase").agg(
        (F.count(F.lit(1)) > 0).alias("tested"), F.count_if(~F.col("ok")).alias("n_failed")
    )


ALL_PHASES = (*DEFAULT_PHASES, "metadata")
FAULTS = {  # what is planted: in whose store, of which layout, the phases that are run and those that have to see it
    "other attribute": ("view", "spatial", ALL_PHASES, ("metadata",)),
    "unknown unit": ("signup", "spatial", DEFAULT_PHASES, ("ranges",)),  # told in both layouts, so only one is looked at
    "other calendar": ("purchase", "spatial", ALL_PHASES, ("structure",)),
    "history in one commit": ("error", "spatial", ALL_PHASES, ("structure",)),
    "changed values": ("click", "spatial", ALL_PHASES, ("samples", "sweep", "metadata")),
    "open identity": ("view", "spatial", ALL_PHASES, ("identities",)),
    "lost chunk": ("error", "spatial", ALL_PHASES, ("sweep", "metadata")),
    "moved axis": ("purchase", "spatial", ALL_PHASES, ("index",)),
    "lost tile": ("view", "temporal", ("structure", "index", "sweep", "metadata"), ("sweep", "metadata")),
    "changed value": ("signup", "temporal", ("structure", "index", "sweep", "metadata"), ("sweep", "metadata")),
}
_FAULT_ROWS = ", ".join(f"('{fault}', '{name}', '{' '.join(run)}', '{' '.join(seen)}')" for fault, (name, _, run, seen) in FAULTS.items())


@query("V1 V2 V3 V4 V5 V6 V7 V8 V9 J15 A12", f"""WITH {STORED_SQL}, f(fault, name, run, seen) AS (VALUES {_FAULT_ROWS}),
      p AS (SELECT fault, name, unnest(string_split(run, ' ')) AS phase, string_split(seen, ' ') AS seen FROM f),
      n AS (SELECT variable, count(*) AS n_cells FROM stored GROUP BY 1)
    SELECT fault, phase, list_contains(seen, phase) AS failed, n_cells FROM p JOIN n ON n.variable = CASE WHEN name = 'purchase' THEN 'purchases' ELSE name || 's' END""")
def damaged_stores(spark, folder):
    """One known fault per store, in both layouts, and which of the phases fail.

    Stores are audited in rounds. In each, the other layout's store of a variable is whole and is what the metadata
    phase compares with, so every store is built once.
    """
    root = fresh_dir(spark, "events-damaged")
    _write_raw(spark, folder, root)
    configs = {}
    for layout in ("spatial", "temporal"):
        made = config_of(root, root, layout)
        configs[layout] = GridConfig({**made.settings, "identities": {"view": ["click"]}}, KEY)
        build_family(spark, configs[layout])
    stores = {(layout, name): Store.open(spark, config.of(name).store_path) for layout, config in configs.items() for name in KEY.variables}
    clean = {key: store.resolve() for key, store in stores.items()}
    n_cells = dict(zip(stores, side_by_side(lambda store: store.cells().count(), list(stores.values()))))

    def box(store):
        sizes = store.state()["sizes"]
        return {"t": (0, sizes["time"]), "i": (0, sizes["lat"]), "j": (0, sizes["lon"])}

    def amended(name, change=lambda state: None, cells=None, layout="spatial"):
        store = stores[layout, name]
        work = store.begin()
        change(work.state)
        if cells is not None:
            work.write_cells(cells, box(store))
        work.commit("planted")

    def audited(fault, config=None):
        name, layout, phases, _ = FAULTS[fault]
        other = configs["temporal" if layout == "spatial" else "spatial"]
        audit = Audit(spark, (config or configs[layout]).of(name), other, samples=3)
        audit.run(phases)
        bad = {phase for phase, _, ok, _ in audit.checks if not ok}
        return [(fault, phase, phase in bad, n_cells[layout, name]) for phase in phases]

    def with_state(key, change):
        def apply(state):
            state[key] = change(json.loads(json.dumps(state[key])))
        return apply

    def furlongs(variables):
        variables["signups"]["attrs"]["units"] = "furlong"
        return variables

    def julian(coordinates):
        coordinates["time"]["calendar"] = "julian"
        return coordinates

    amended("view", with_state("attrs", lambda attrs: {**attrs, "institution": "elsewhere"}))
    amended("signup", with_state("variables", furlongs))
    amended("purchase", with_state("coordinates", julian))
    squeezed, told = config_of(root, fresh_dir(spark, "events-squeezed"), "spatial"), stores["spatial", "error"]
    work = Store.open_or_create(spark, squeezed.of("error").store_path).begin()
    work.state = told.state()
    work.write_cells(told.cells(), box(told))
    work.write_dims(told.dims())
    work.commit("all of it")
    rows = side_by_side(lambda fault: audited(fault, squeezed if fault == "history in one commit" else None), list(FAULTS)[:4])

    for name in ("view", "purchase", "signup"):
        stores["spatial", name].reset(clean["spatial", name])
    halved = (F.col("value") / 2).cast("float").alias("value")
    amended("click", cells=stores["spatial", "click"].cells().select("t", "i", "j", halved))
    audit = Audit(spark, configs["spatial"].of("error"), samples=3)
    looked_at = {*audit.sampled(), *audit.spots(audit.options["range_days"])}
    gone = next(t for t in range(audit.sizes["time"]) if t not in looked_at)
    amended("error", cells=told.cells().where(F.col("t") != gone))
    raw = RawVariable(spark, configs["spatial"], "purchase")
    moved = spark.read.schema(SCHEMA).parquet(raw.files[0]).withColumn("lat", F.col("lat") + F.when(F.col("i") == 7, 0.5).otherwise(0.0))
    moved.sortWithinPartitions("local_t", "i", "j").write.parquet(f"{root}/moved")
    SharedFs(spark, root).delete(raw.files[0])
    SharedFs(spark, root).move(f"{root}/moved", raw.files[0])
    rows += side_by_side(audited, list(FAULTS)[4:8])

    held = stores["temporal", "view"]
    tile = held.manifest().orderBy("n_valid", "ci", "cj").select("ci", "cj").first()
    lost = (F.floor(F.col("i") / 6) == tile.ci) & (F.col("j") == tile.cj)
    amended("view", cells=held.cells().where(~lost).sortWithinPartitions("i", "j", "t"), layout="temporal")
    held = stores["temporal", "signup"]
    last = held.cells().agg(F.max(F.struct("t", "i", "j")).alias("at")).first().at
    here = (F.col("t") == last.t) & (F.col("i") == last.i) & (F.col("j") == last.j)
    nudged = F.when(here, (F.col("value").cast("double") * (1 + 2.0**-23)).cast("float")).otherwise(F.col("value"))
    amended("signup", cells=held.cells().withColumn("value", nudged), layout="temporal")
    rows += side_by_side(audited, list(FAULTS)[8:])
    return spark.createDataFrame([r for part in rows for r in part], "fault string, phase string, failed boolean, n_cells long")


@query("R7 R8 K8 K11 K12 K13 A17 X25 O5", f"""WITH {SPAN_SQL} SELECT DISTINCT variable, 'attrs then tag' AS remaining_before, '' AS remaining_after,
      CAST(0 AS BIGINT) AS gc_failed, n_batches + 2 AS snapshots FROM cells, span""")
def finalized_stores(spark, folder):
    """Attributes, tag and collection, in that order; what is left to do afterwards."""
    (config,) = built(spark, folder, "spatial", own=True)

    def finish(name):
        store, own = finalize.open_for(spark, config, name)
        own = GridConfig({**own.settings, "attrs": {**own.settings["attrs"], "comment": "checked"}}, KEY)
        before = finalize.status(store, own)
        finalize.write_attrs(store, own, apply=True)
        finalize.create_tag(store, "v1", apply=True)
        failed = finalize.collect(store, apply=True)
        after = finalize.status(store, own)
        remaining = (" then ".join(s["remaining"]) for s in (before, after))
        return (name, *remaining, failed, after["reachable_snapshots"])

    rows = side_by_side(finish, list(KEY.variables))
    return spark.createDataFrame(rows, "variable string, remaining_before string, remaining_after string, gc_failed int, snapshots int")


@query("K1 K2 S5", f"""WITH {SPAN_SQL} SELECT variable, t - t0 AS t, i, j, CAST(CAST(cents / 100.0 AS FLOAT) AS DOUBLE) AS value
    FROM cells, span WHERE cents % 7 <> 0""")
def stream_append(spark, folder):
    """Every variable's days as they arrive, a commit per micro-batch; then each query once
    more, which finds nothing new."""
    root = fresh_dir(spark, "stream")
    rows = cut_lineage(raw_grid(spark, folder))
    ends = rows.agg((F.max("j") + 1).alias("east"), F.max("part").alias("part")).first()
    grid = {"lat": N_LAT, "lon": ends.east}
    stores = {name: Store.open_or_create(spark, f"{root}/store/{name}") for name in KEY.variables}

    def drain(name):
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in/{name}")
        append_stream(stream, stores[name], grid, {"time": 1, **grid}, name, f"{root}/checkpoint/{name}").awaitTermination()

    for part in range(ends.part + 2):
        if part <= ends.part:
            arrived = rows.where(F.col("part") == part).drop("part")
            arrived.repartition("variable").write.partitionBy("variable").parquet(f"{root}/arrived/{part}")
            fs = SharedFs(spark, root)
            for folder_, _, _ in fs.list(f"{root}/arrived/{part}"):
                if folder_.startswith("variable="):
                    fs.move(f"{root}/arrived/{part}/{folder_}", f"{root}/in/{folder_.partition('=')[2]}/part={part}")
        side_by_side(drain, list(KEY.variables))
    cells = [s.cells().select(F.lit(name).alias("variable"), "t", "i", "j", F.col("value").cast("double").alias("value")) for name, s in stores.items()]
    return fold(DataFrame.unionByName, cells)
