"""Means, shares, percentiles, tile statistics and residuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcube.catalog.registry import query
from gridcube.functions import grid
from gridcube.functions.fixed import BOUNDS_BY_UNITS
from gridcube.functions.quantiles import exact_percentiles, robust_limits as limits_of
from gridcube.operators import merge, reduce, select
from gridcube.sources.tables import (
    EVENTS_SQL, N_LAT, RAW_SQL, SHIPS_SQL, event_cells, lat_of, lon_of, raw_event_cells, ship_cells,
)

W_SQL = "cos(radians(87.5 - 5.0 * i))"


@query("A1 J17 X19", f"""WITH {EVENTS_SQL} SELECT variable,
      round(sum(cents * {W_SQL}) / sum({W_SQL}), 3) AS land_mean FROM cells GROUP BY 1""")
def land_mean(spark, folder):
    means = reduce.land_mean(event_cells(spark, folder), ["variable"], lat_of(F.col("i")), "cents")
    return means.select("variable", F.round("land_mean", 3).alias("land_mean"))


@query("A2 J17", f"""WITH {SHIPS_SQL} SELECT variable, date,
      round(sum(cents * {W_SQL}) / sum({W_SQL}), 3) AS land_mean
    FROM ships WHERE 87.5 - 5.0 * i BETWEEN 22 AND 52 AND date BETWEEN DATE '1998-06-01' AND DATE '1999-07-30'
    GROUP BY 1, 2""")
def land_mean_daily(spark, folder):
    """The regional daily series."""
    cells = ship_cells(spark, folder).withColumn("lat", lat_of(F.col("i")))
    region = select.sel_descending(select.sel_time(cells, "1998-06-01", "1999-07-30"), "lat", 52, 22)
    means = reduce.land_mean(region, ["variable", "date"], F.col("lat"), "cents")
    return means.select("variable", "date", F.round("land_mean", 3).alias("land_mean"))


@query("A3", f"""WITH {EVENTS_SQL} SELECT variable, i, j, round(avg(cents), 4) AS time_mean
    FROM cells GROUP BY 1, 2, 3""")
def time_mean_cell(spark, folder):
    means = reduce.time_mean(event_cells(spark, folder), ["variable", "i", "j"], "cents")
    return means.select("variable", "i", "j", F.round("time_mean", 4).alias("time_mean"))


@query("A4", f"""WITH {SHIPS_SQL} SELECT variable, i, make_date(year(date), 12, 31) AS year_end,
      round(avg(cents), 4) AS annual_mean FROM ships GROUP BY 1, 2, 3""")
def annual_resample(spark, folder):
    means = reduce.annual_mean(ship_cells(spark, folder), ["variable", "i"], "cents")
    return means.select("variable", "i", "year_end", F.round("annual_mean", 4).alias("annual_mean"))


@query("A5", f"""WITH {SHIPS_SQL} SELECT variable, p AS percent, round(
      CASE p WHEN 1.0 THEN quantile_cont(cents, 0.01) WHEN 2.0 THEN quantile_cont(cents, 0.02)
             WHEN 50.0 THEN quantile_cont(cents, 0.5) WHEN 98.0 THEN quantile_cont(cents, 0.98)
             ELSE quantile_cont(cents, 0.995) END, 3) AS value
    FROM ships, (VALUES (CAST(1.0 AS DOUBLE)), (2.0), (50.0), (98.0), (99.5)) v(p) GROUP BY variable, p""")
def percentiles(spark, folder):
    found = exact_percentiles(ship_cells(spark, folder), ["variable"], "cents", [1.0, 2.0, 50.0, 98.0, 99.5], costly=True)
    return found.select("variable", "percent", F.round("value", 3).alias("value"))


@query("A5", f"""WITH {SHIPS_SQL}, m AS (SELECT variable, i, j,
      avg(CASE WHEN year(date) = 1999 THEN cents END) - avg(CASE WHEN year(date) = 1996 THEN cents END) AS d
      FROM ships WHERE year(date) IN (1996, 1999) GROUP BY 1, 2, 3),
    q AS (SELECT variable, greatest(abs(quantile_cont(d, 0.01)), abs(quantile_cont(d, 0.99))) AS b
      FROM m WHERE d IS NOT NULL GROUP BY 1)
    SELECT variable, round(-b, 3) AS vmin, round(b, 3) AS vmax FROM q""")
def robust_limits(spark, folder):
    """Limits of a difference field, centred on zero."""
    field = reduce.period_difference(
        ship_cells(spark, folder), ["variable", "i", "j"], select.period("1999"), select.period("1996"), "cents"
    )
    found = limits_of(field, ["variable"], "difference", 1.0, 99.0, symmetric=True, costly=True)
    return found.select("variable", F.round("vmin", 3).alias("vmin"), F.round("vmax", 3).alias("vmax"))


_PARTS = ("click", "error", "purchase", "signup")
_WIDE_SQL = EVENTS_SQL + """, wide AS (SELECT t, i, j,
      max(CASE WHEN variable = 'view' THEN cents END) AS view, max(CASE WHEN variable = 'click' THEN cents END) AS click,
      max(CASE WHEN variable = 'error' THEN cents END) AS error, max(CASE WHEN variable = 'purchase' THEN cents END) AS purchase,
      max(CASE WHEN variable = 'signup' THEN cents END) AS signup FROM cells GROUP BY t, i, j)"""


def _event_axes(spark, folder):
    """(variable, axis, position): every variable has all days, rows and columns of the grid."""
    cells = event_cells(spark, folder)
    ends = cells.agg(F.min("t").alias("a"), F.max("t").alias("b"), F.max("j").alias("east")).first()
    spans = [("t", ends.a, ends.b), ("i", 0, N_LAT - 1), ("j", 0, ends.east)]
    each = F.array(*[F.struct(F.lit(axis).alias("axis"), F.sequence(F.lit(a).cast("long"), F.lit(b).cast("long")).alias("at")) for axis, a, b in spans])
    whole = cells.select("variable").distinct().select("variable", F.explode(each).alias("p"))
    return whole.select("variable", "p.axis", F.explode("p.at").alias("position"))


@query("J1 P6", f"WITH {_WIDE_SQL} SELECT t, i, j, view, click, error, purchase, signup FROM wide")
def merge_exact(spark, folder):
    """All variables side by side, after their axes were compared: the same days, rows and columns."""
    return merge.merge_exact(event_cells(spark, folder), ["view", *_PARTS], "cents", _event_axes(spark, folder))


@query("J1", f"""WITH {SHIPS_SQL}, p AS (SELECT DISTINCT 't' AS axis, t AS position, variable FROM ships
      UNION SELECT DISTINCT 'i', i, variable FROM ships UNION SELECT DISTINCT 'j', j, variable FROM ships)
    SELECT axis, position, count(*) AS n_variables FROM p GROUP BY 1, 2 HAVING count(*) < 3""")
def axis_mismatches(spark, folder):
    return merge.axis_mismatches(merge.positions(ship_cells(spark, folder)), ["A", "N", "R"])


_SHORT_SQL = EVENTS_SQL + """, g AS (SELECT min(t) AS a, max(t) AS b, max(j) AS east FROM cells), v AS (SELECT DISTINCT variable FROM cells),
      axes AS (SELECT variable, 't' AS axis, unnest(range(a, b + 1)) AS position FROM v, g
        UNION ALL SELECT variable, 'i', unnest(range(36)) FROM v UNION ALL SELECT variable, 'j', unnest(range(east + 1)) FROM v, g),
      short AS (SELECT axes.* FROM axes, g WHERE NOT (variable = 'view' AND axis = 't' AND position > b - 3) AND NOT (variable = 'click' AND axis = 'i' AND position = 7))"""


@query("J1 J5", f"""WITH {_SHORT_SQL} SELECT axis, position, count(*) AS n_variables FROM short GROUP BY 1, 2
    HAVING count(*) < (SELECT count(*) FROM v)""")
def unequal_axes(spark, folder):
    """Two variables whose axes are shorter: a merge refuses them, and this is why."""
    axes = _event_axes(spark, folder)
    last = axes.where("axis = 't'").agg(F.max("position").alias("b")).first().b
    short = axes.where(~((F.col("variable") == "view") & (F.col("axis") == "t") & (F.col("position") > last - 3)))
    short = short.where(~((F.col("variable") == "click") & (F.col("axis") == "i") & (F.col("position") == 7)))
    names = ["view", *_PARTS]
    try:
        merge.merge_exact(event_cells(spark, folder), names, "cents", short)
    except merge.AxesDiffer:
        return merge.axis_mismatches(short, names)
    raise AssertionError("unequal axes were merged")


def _m(name):
    return f"sum(CASE WHEN {name} IS NOT NULL THEN {name} * w END) / sum(CASE WHEN {name} IS NOT NULL THEN w END)"


@query("A6 A1 J7", f"""WITH {_WIDE_SQL}, f AS (SELECT *, {W_SQL} AS w FROM wide WHERE view IS NOT NULL),
    m AS (SELECT {_m('view')} AS total, {_m('click')} AS a, {_m('error')} AS b, {_m('purchase')} AS c, {_m('signup')} AS d FROM f),
    r AS (SELECT 'click' AS component, a AS v, total FROM m UNION ALL SELECT 'error', b, total FROM m
      UNION ALL SELECT 'purchase', c, total FROM m UNION ALL SELECT 'signup', d, total FROM m
      UNION ALL SELECT 'sum of components', coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) + coalesce(d, 0), total FROM m
      UNION ALL SELECT 'view', total, total FROM m)
    SELECT component, round(v, 3) AS land_mean, round(100 * v / total, 4) AS share_pct FROM r""")
def component_shares(spark, folder):
    wide = merge.merge_exact(event_cells(spark, folder), ["view", *_PARTS], "cents")
    shares = reduce.component_shares(wide, "view", _PARTS, lat_of(F.col("i")))
    return shares.select(
        "component", F.round("land_mean", 3).alias("land_mean"), F.round("share_pct", 4).alias("share_pct")
    )


@query("A7", f"""WITH {_WIDE_SQL} SELECT component, n AS n_excess FROM (
      SELECT 'click' AS component, count(*) FILTER (WHERE click IS NOT NULL AND view IS NULL) AS n FROM wide
      UNION ALL SELECT 'error', count(*) FILTER (WHERE error IS NOT NULL AND view IS NULL) FROM wide
      UNION ALL SELECT 'purchase', count(*) FILTER (WHERE purchase IS NOT NULL AND view IS NULL) FROM wide
      UNION ALL SELECT 'signup', count(*) FILTER (WHERE signup IS NOT NULL AND view IS NULL) FROM wide)""")
def footprint_excess(spark, folder):
    wide = merge.merge_exact(event_cells(spark, folder), ["view", *_PARTS], "cents")
    return reduce.footprint_excess(wide, "view", _PARTS)


TILE_SQL = RAW_SQL + """, tiles AS (SELECT variable, t, i // 6 AS ci, j // 2 AS cj,
      count(*) FILTER (WHERE value <> -999) AS n_valid FROM raw GROUP BY 1, 2, 3, 4)"""


@query("A8", f"WITH {TILE_SQL} SELECT * FROM tiles")
def tile_valid_counts(spark, folder):
    return reduce.tile_valid_counts(raw_event_cells(spark, folder), ["variable", "t"], 6, 2)


@query("A9 S18", f"""WITH {TILE_SQL} SELECT variable, ci, cj, bool_or(n_valid > 0) AS ever_valid
    FROM tiles, (SELECT min(t) AS a, max(t) - min(t) AS n FROM tiles) g WHERE t IN (a, a + n // 3, a + 2 * n // 3, a + n) GROUP BY 1, 2, 3""")
def tile_any_valid(spark, folder):
    """Tiles that hold data on any of four days, spread evenly from the first to the last."""
    cells = raw_event_cells(spark, folder)
    ends = event_cells(spark, folder).agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    n = ends.b - ends.a
    days = cells.where(F.col("t").isin(*(ends.a + k * n // 3 for k in range(4))))
    counts = reduce.tile_valid_counts(days, ["variable", "t"], 6, 2)
    return counts.groupBy("variable", "ci", "cj").agg(F.bool_or(F.col("n_valid") > 0).alias("ever_valid"))


# The plane in the middle of the record, and how many cells each tile of it has.
STRATA_SQL = TILE_SQL + """, g AS (SELECT min(t) + (max(t) - min(t) + 1) // 2 AS mid, max(j) + 1 AS n_lon FROM raw),
    counts AS (SELECT variable, ci, cj, n_valid, 6 * least(2, n_lon - cj * 2) AS area FROM tiles, g WHERE t = mid),
    strata AS (SELECT variable, ci, cj, n_valid, CASE WHEN n_valid = area THEN 'covered' WHEN n_valid > 0 THEN 'coastal'
      ELSE 'empty' END AS stratum FROM counts)"""


def strata(spark, folder):
    """Tiles of the plane in the middle of the record, by how much of them holds data."""
    cells = raw_event_cells(spark, folder)
    ends = event_cells(spark, folder).agg(F.min("t").alias("a"), F.max("t").alias("b"), F.max("j").alias("east")).first()
    plane = cells.where(F.col("t") == ends.a + (ends.b - ends.a + 1) // 2)
    area = 6 * F.least(F.lit(2), ends.east + 1 - F.col("cj") * 2)
    return reduce.land_strata(reduce.tile_valid_counts(plane, ["variable"], 6, 2), area)


@query("V11", f"WITH {STRATA_SQL} SELECT variable, ci, cj, n_valid, stratum FROM strata")
def land_strata(spark, folder):
    return strata(spark, folder)


_UNITS = {"click": "mm d-1", "error": "W m-2", "purchase": "m3 m-3", "signup": "unitless"}
_UNITS_SQL = ("CASE variable WHEN 'click' THEN 'mm d-1' WHEN 'error' THEN 'W m-2' "
              "WHEN 'purchase' THEN 'm3 m-3' WHEN 'signup' THEN 'unitless' ELSE 'furlong' END")


@query("A10 V8 X23", f"""WITH {RAW_SQL}, b(units, lo, hi) AS (VALUES ('mm d-1', -50.0, 200.0), ('W m-2', -1000.0, 1000.0),
      ('m3 m-3', 0.0, 1.0), ('unitless', 0.0, 1.0)),
    r AS (SELECT variable, {_UNITS_SQL} AS units, count(*) AS n_valid, CAST(min(value) AS DOUBLE) AS low,
      CAST(max(value) AS DOUBLE) AS high FROM raw WHERE value <> -999 AND isfinite(value) GROUP BY 1, 2)
    SELECT variable, r.units, n_valid, low, high, coalesce(low >= lo AND high <= hi, false) AS within_bounds
    FROM r LEFT JOIN b ON r.units = b.units""")
def range_bounds(spark, folder):
    """Inclusive bounds by unit. An unknown unit fails; it is not skipped."""
    clean = raw_event_cells(spark, folder).withColumn("value", grid.decoded(F.col("value")))
    units = F.lit("furlong")
    for name, unit in _UNITS.items():
        units = F.when(F.col("variable") == name, unit).otherwise(units)
    seen = reduce.value_ranges(clean, ["variable"]).withColumn("units", units)
    bounds = spark.createDataFrame(
        [(u, *b) for u, b in BOUNDS_BY_UNITS.items()], "units string, lo double, hi double"
    )
    ok = (F.col("low") >= F.col("lo")) & (F.col("high") <= F.col("hi"))
    # the bounds table is a constant of four rows
    return seen.join(F.broadcast(bounds), "units", "left").select(
        "variable", "units", "n_valid", "low", "high", F.coalesce(ok, F.lit(False)).alias("within_bounds")
    )


@query("A11", f"""WITH {RAW_SQL}, d AS (SELECT variable, t, count(*) FILTER (WHERE value <> -999 AND NOT isnan(value)) AS n
      FROM raw GROUP BY 1, 2)
    SELECT variable, count(*) AS n_boxes, min(n) AS fewest, max(n) AS most, count(DISTINCT n) AS n_different FROM d GROUP BY 1""")
def footprint_movement(spark, folder):
    """How far the number of valid cells moves from day to day."""
    clean = grid.decoded(F.col("value"))
    daily = raw_event_cells(spark, folder).groupBy("variable", "t").agg(F.count(clean).alias("n"))
    return daily.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_boxes"), F.min("n").alias("fewest"), F.max("n").alias("most"),
        F.countDistinct("n").alias("n_different"),
    )


@query("V7 A12 J15", f"""WITH {_WIDE_SQL}, x AS (SELECT t, CAST(click / 100.0 AS FLOAT) AS a, CAST(error / 100.0 AS FLOAT) AS b,
      CAST(purchase / 100.0 AS FLOAT) AS c,
      CAST((click + error + purchase + CASE WHEN (t + i + j) % 17 = 0 THEN 5 ELSE 0 END) / 100.0 AS FLOAT) AS total FROM wide),
    r AS (SELECT t, abs(total - ((a + b) + c)) AS r FROM x)
    SELECT t, count(r) AS n_tested, round(CAST(max(r) AS DOUBLE), 6) AS worst,
      count(*) FILTER (WHERE r > CAST(0.0001 AS FLOAT)) AS n_over FROM r GROUP BY t""")
def identity_residual(spark, folder):
    """A total against its components in float32, with a known gap in some cells."""
    parts = ("click", "error", "purchase")
    wide = merge.merge_exact(event_cells(spark, folder), parts, "cents")
    extra = F.when((F.col("t") + F.col("i") + F.col("j")) % 17 == 0, 5).otherwise(0)
    total = ((F.col("click") + F.col("error") + F.col("purchase") + extra) / 100).cast("float")
    floats = [(F.col(p) / 100).cast("float") for p in parts]
    rows = wide.select("t", reduce.residual(total, floats).alias("r"))
    totals = reduce.residual_totals(rows, ["t"], "r", F.lit(1e-4).cast("float"))
    return totals.select("t", "n_tested", F.round(F.col("worst").cast("double"), 6).alias("worst"), "n_over")


@query("A13", f"""WITH {RAW_SQL} SELECT variable, i, j, bool_and(value = -999) AS all_fill FROM raw GROUP BY 1, 2, 3""")
def all_fill_boxes(spark, folder):
    return reduce.all_fill(raw_event_cells(spark, folder), ["variable", "i", "j"])


@query("A16", f"""WITH {EVENTS_SQL} SELECT variable, strftime(min(date), '%Y-%m-%d') AS time_coverage_start,
      strftime(max(date), '%Y-%m-%d') AS time_coverage_end, round(min(87.5 - 5.0 * i), 4) AS geospatial_lat_min,
      round(max(87.5 - 5.0 * i), 4) AS geospatial_lat_max, round(min(-179.75 + 0.5 * j), 4) AS geospatial_lon_min,
      round(max(-179.75 + 0.5 * j), 4) AS geospatial_lon_max
    FROM (SELECT variable, date, CAST(i AS DOUBLE) AS i, CAST(j AS DOUBLE) AS j FROM cells) GROUP BY 1""")
def coverage_attrs(spark, folder):
    return reduce.coverage(
        event_cells(spark, folder), ["variable"], lat_of(F.col("i")), lon_of(F.col("j"))
    )


@query("A20 V10", f"""WITH {TILE_SQL}, d AS (SELECT variable, t, CAST(sum(n_valid) AS BIGINT) AS n FROM tiles GROUP BY 1, 2)
    SELECT variable AS phase, count(*) AS n_checks, count(*) FILTER (WHERE n < 20) AS n_failed FROM d GROUP BY 1""")
def check_tally(spark, folder):
    """One check per day, that enough cells are valid; then the tally per phase."""
    daily = (
        reduce.tile_valid_counts(raw_event_cells(spark, folder), ["variable", "t"], 6, 2)
        .groupBy("variable", "t").agg(F.sum("n_valid").alias("n"))
    )
    return reduce.tally(daily.select(F.col("variable").alias("phase"), (F.col("n") >= 20).alias("ok")))


@query("J2", f"""WITH {EVENTS_SQL}, s AS (SELECT * FROM cells WHERE (t + 3 * i + j) % 29 <> 0),
    w AS (SELECT variable, t, i, j, CASE WHEN (t + i + j) % 31 = 0 THEN cents + 1 ELSE cents END AS cents FROM cells
      WHERE (t + i + 2 * j) % 37 <> 0)
    SELECT variable, count(*) FILTER (WHERE s.cents IS NULL OR w.cents IS NULL) AS n_mask_differs,
      count(*) FILTER (WHERE s.cents <> w.cents) AS n_value_differs,
      count(*) FILTER (WHERE w.cents IS NOT NULL) AS n_valid
    FROM s FULL OUTER JOIN w USING (variable, t, i, j) GROUP BY variable""")
def compare_with_raw(spark, folder):
    """Two versions of one grid, each with holes of its own and some changed values."""
    cells = event_cells(spark, folder)
    stored = cells.where("(t + 3 * i + j) % 29 <> 0")
    changed = F.when((F.col("t") + F.col("i") + F.col("j")) % 31 == 0, F.col("cents") + 1).otherwise(F.col("cents"))
    raw = cells.where("(t + i + 2 * j) % 37 <> 0").withColumn("cents", changed)
    rows = merge.compared(stored, raw, ["variable", "t", "i", "j"], "cents")
    return merge.comparison_totals(rows, ["variable"])


@query("A21", f"""WITH {EVENTS_SQL}, b AS (SELECT DISTINCT variable, i // 6 AS ci, j // 2 AS cj FROM cells)
    SELECT variable, count(*) AS n_boxes, CAST(sum(6 * 2) * (SELECT max(t) - min(t) + 1 FROM cells) AS BIGINT) AS n_cells FROM b GROUP BY 1""")
def compared_cells(spark, folder):
    """Cells a comparison of every written tile through the whole record covers."""
    cells = event_cells(spark, folder)
    n_days = cells.agg((F.max("t") - F.min("t") + 1).alias("n")).first().n
    boxes = cells.select(
        "variable", grid.block(F.col("i"), 6).alias("ci"), grid.block(F.col("j"), 2).alias("cj")
    ).distinct()
    volume = F.lit(n_days * 6 * 2)
    return boxes.groupBy("variable").agg(F.count(F.lit(1)).alias("n_boxes"), F.sum(volume).alias("n_cells"))
