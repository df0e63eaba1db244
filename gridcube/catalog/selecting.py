"""Selections, projections and rechunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcube.catalog.registry import query
from gridcube.functions import grid
from gridcube.operators import chunks, reduce, select
from gridcube.sources.tables import (
    EVENTS_SQL, N_LAT, RAW_SQL, SHIPS_SQL, event_cells, lat_of, lon_of, raw_event_cells, ship_cells,
)


@query("S11 U6", f"WITH {EVENTS_SQL} SELECT variable, t, i, j, cents FROM cells")
def cube_cells(spark, folder):
    return event_cells(spark, folder).select("variable", "t", "i", "j", "cents")


@query("P1", f"""WITH {EVENTS_SQL} SELECT variable, t, i, j, cents FROM cells
    WHERE t >= 3 AND t < 10 AND i >= 6 AND i < 18 AND j >= 0 AND j < 3""")
def isel_box(spark, folder):
    box = select.isel(event_cells(spark, folder, steps=(3, 10)), i=(6, 18), j=(0, 3))
    return box.select("variable", "t", "i", "j", "cents")


@query("P2", f"""WITH {EVENTS_SQL} SELECT variable, i, j, cents FROM cells
    WHERE date = DATE '2024-01-15'""")
def sel_day(spark, folder):
    return select.sel_time(event_cells(spark, folder), "2024-01-15").select("variable", "i", "j", "cents")


@query("P3", f"""WITH {SHIPS_SQL} SELECT variable, date, i, j, cents FROM ships
    WHERE date >= DATE '1997-07-01' AND date < DATE '1997-08-01'""")
def sel_partial_date(spark, folder):
    return select.sel_time(ship_cells(spark, folder), "1997-07").select("variable", "date", "i", "j", "cents")


@query("P4", f"""WITH {EVENTS_SQL} SELECT variable, t, 87.5 - 5.0 * i AS lat, -179.75 + 0.5 * j AS lon, cents
    FROM (SELECT variable, t, CAST(i AS DOUBLE) AS i, CAST(j AS DOUBLE) AS j, cents FROM cells)
    WHERE 87.5 - 5.0 * i BETWEEN 22 AND 52 AND -179.75 + 0.5 * j BETWEEN -179.5 AND -170""")
def sel_label_range(spark, folder):
    cells = event_cells(spark, folder).select(
        "variable", "t", lat_of(F.col("i")).alias("lat"), lon_of(F.col("j")).alias("lon"), "cents"
    )
    return select.sel_ascending(select.sel_descending(cells, "lat", 52, 22), "lon", -179.5, -170)


@query("P5 J6", f"""WITH {EVENTS_SQL}, spot AS (
      SELECT arg_min(i, (abs(87.5 - 5.0 * i - 13.4), i)) AS i FROM (SELECT DISTINCT i FROM cells))
    SELECT c.variable, c.date, c.i, c.j, c.cents FROM cells c SEMI JOIN spot ON c.i = spot.i""")
def sel_nearest(spark, folder):
    cells = event_cells(spark, folder)
    axis = cells.select("i").distinct().withColumn("lat", lat_of(F.col("i")))
    at = select.nearest(axis, "i", "lat", 13.4)
    # one row, so broadcasting it is safe at any scale
    return cells.join(F.broadcast(at), "i", "left_semi").select("variable", "date", "i", "j", "cents")


@query("P6 J7", f"""WITH {EVENTS_SQL} SELECT c.variable, c.t, c.i, c.j, c.cents FROM cells c
    SEMI JOIN (SELECT t, i, j FROM cells WHERE variable = 'view') f
      ON c.t = f.t AND c.i = f.i AND c.j = f.j WHERE c.variable <> 'view'""")
def mask_footprint(spark, folder):
    cells = event_cells(spark, folder)
    footprint = cells.where("variable = 'view'")
    return select.masked_to(cells.where("variable <> 'view'"), footprint, ["t", "i", "j"]).select(
        "variable", "t", "i", "j", "cents"
    )


@query("P7 P8 P9", f"""WITH {RAW_SQL} SELECT variable, count(*) AS n_cells,
      CAST(sum(CASE WHEN value = -999 THEN 1 ELSE 0 END) AS BIGINT) AS n_sentinel,
      CAST(sum(CASE WHEN isnan(value) THEN 1 ELSE 0 END) AS BIGINT) AS n_nan,
      CAST(sum(CASE WHEN isfinite(value) AND value <> -999 THEN 1 ELSE 0 END) AS BIGINT) AS n_finite,
      CAST(sum(CASE WHEN value = -999 OR isnan(value) THEN -100
               ELSE CAST(round(CAST(value AS DOUBLE) * 100) AS BIGINT) END) AS BIGINT) AS filled_cents
    FROM raw GROUP BY variable""")
def sentinel_decode(spark, folder):
    raw = raw_event_cells(spark, folder)
    value = F.col("value")
    clean = grid.decoded(value)
    return raw.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count_if(value == grid.fill()).alias("n_sentinel"),
        F.count_if(F.isnan(value)).alias("n_nan"),
        F.count_if(grid.is_finite(clean)).alias("n_finite"),
        F.sum(F.round(grid.filled(clean, -1.0) * 100).cast("long")).alias("filled_cents"),
    )


@query("S7 S8 S22", f"""WITH {RAW_SQL} SELECT variable, t, i, j, CAST(value AS DOUBLE) AS value FROM raw
    WHERE i >= 10 AND i < 20 AND j < 2 AND t BETWEEN 5 AND 8 AND NOT isnan(value)""")
def raw_window(spark, folder):
    """A window of undecoded cells: the sentinel stays what it is."""
    window = select.isel(raw_event_cells(spark, folder), t=(5, 9), i=(10, 20), j=(0, 2))
    return window.where(~F.isnan("value")).select(
        "variable", "t", "i", "j", F.col("value").cast("double").alias("value")
    )


@query("P12", f"""WITH {EVENTS_SQL} SELECT variable, t, count(*) AS n FROM cells
    WHERE variable IN ('click', 'purchase') GROUP BY 1, 2""")
def variable_subset(spark, folder):
    picked = select.of_variables(event_cells(spark, folder), ["click", "purchase"])
    return picked.groupBy("variable", "t").agg(F.count(F.lit(1)).alias("n"))


@query("P13 A3", f"""WITH {SHIPS_SQL}, m AS (SELECT variable, i, j,
      avg(CASE WHEN date >= DATE '1997-07-01' AND date < DATE '1997-08-01' THEN cents END) AS a,
      avg(CASE WHEN date >= DATE '1997-01-01' AND date < DATE '1997-02-01' THEN cents END) AS b
      FROM ships WHERE (date >= DATE '1997-07-01' AND date < DATE '1997-08-01')
        OR (date >= DATE '1997-01-01' AND date < DATE '1997-02-01') GROUP BY 1, 2, 3)
    SELECT variable, i, j, round(a - b, 4) AS difference FROM m WHERE a - b IS NOT NULL""")
def season_difference(spark, folder):
    summer, winter = select.period("1997-07"), select.period("1997-01")
    both = reduce.period_difference(ship_cells(spark, folder), ["variable", "i", "j"], summer, winter, "cents")
    return both.where("difference is not null").select(
        "variable", "i", "j", F.round("difference", 4).alias("difference")
    )


@query("P14 O2", f"""WITH {EVENTS_SQL} SELECT 35 - i AS row_from_south, i AS row_from_north,
      CAST(sum(cents) AS BIGINT) AS cents FROM cells GROUP BY 1, 2""")
def row_orientation(spark, folder):
    south = F.lit(N_LAT - 1) - F.col("i")
    return (
        event_cells(spark, folder)
        .groupBy(south.alias("row_from_south"),
                 select.north_up(south, N_LAT, ascending=True).alias("row_from_north"))
        .agg(F.sum("cents").alias("cents"))
    )


CHUNKS = {"time": 10, "lat": 6, "lon": 2}


@query("P11 X26 K6", f"""WITH {EVENTS_SQL} SELECT variable, t // 10 AS ct, i // 6 AS ci, j // 2 AS cj,
      count(*) AS n_cells, string_agg(CAST(cents AS VARCHAR), ',' ORDER BY t, i, j) AS series
    FROM cells GROUP BY 1, 2, 3, 4""")
def rechunk_tiles(spark, folder):
    rows = chunks.packed(event_cells(spark, folder), ["variable"], CHUNKS, "cents")
    return rows.select(
        "variable", "ct", "ci", "cj", F.size("values").cast("long").alias("n_cells"),
        F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("series"),
    )


@query("X26", f"WITH {EVENTS_SQL} SELECT variable, t, i, j, cents AS value FROM cells")
def unpack_chunks(spark, folder):
    """Cells to chunk arrays and back loses nothing."""
    rows = chunks.packed(event_cells(spark, folder), ["variable"], CHUNKS, "cents")
    return chunks.unpacked(rows, ["variable"])


@query("X26", """SELECT vec_id, CAST(label AS BIGINT) AS label,
      round(list_sum(list_transform(list_zip(embedding[1:32], embedding[33:64]),
        lambda p: abs(CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)))), 6) AS residual,
      len(list_filter(embedding, lambda v: v > 0)) AS n_positive FROM embeddings""")
def array_residual(spark, folder):
    from gridcube.sources.tables import table

    first, second = F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)
    gaps = F.zip_with(first, second, lambda a, b: F.abs(a.cast("double") - b.cast("double")))
    return table(spark, folder, "embeddings").select(
        "vec_id", "label",
        F.round(F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v), 6).alias("residual"),
        F.size(F.filter("embedding", lambda v: v > 0)).alias("n_positive"),
    )


@query("X20 X21 S6", """SELECT DISTINCT CAST(l_shipdate AS DATE) AS date,
      date_diff('day', DATE '1900-01-01', CAST(l_shipdate AS DATE)) AS days,
      strftime(l_shipdate, '%Y') AS year FROM lineitem""")
def day_numbers(spark, folder):
    from gridcube.sources.tables import table

    date = F.to_date("l_shipdate")
    axis = table(spark, folder, "lineitem").select(date.alias("d")).distinct()
    days = grid.day_number(F.col("d"))
    return axis.select(
        grid.day_date(days).alias("date"), days.alias("days"), F.date_format("d", "yyyy").alias("year")
    )
