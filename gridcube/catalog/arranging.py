"""Axes, files, rankings, draws."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcube.catalog.registry import query
from gridcube.functions import grid, text
from gridcube.operators import axes, chunks, merge, ordering
from gridcube.sources.tables import (
    EVENTS_SQL, SHIP_START, event_cells, table,
)
from gridcube.catalog.reducing import STRATA_SQL, strata

# One source file per return flag and year, as a yearly archive would hold them.
FILES_SQL = """days AS (SELECT DISTINCT l_returnflag AS variable, year(l_shipdate) AS file,
      CAST(l_shipdate AS DATE) AS date FROM lineitem),
    files AS (SELECT variable, file, count(*) AS n_steps FROM days GROUP BY 1, 2),
    offs AS (SELECT variable, file, n_steps, CAST(coalesce(sum(n_steps) OVER (PARTITION BY variable ORDER BY file
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_step FROM files)"""
AXIS_SQL = """axis AS (SELECT variable, date, row_number() OVER (PARTITION BY variable ORDER BY date) - 1 AS idx
      FROM (SELECT DISTINCT l_returnflag AS variable, CAST(l_shipdate AS DATE) AS date FROM lineitem))"""


def _days(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("variable"), F.to_date("l_shipdate").alias("date")
    ).distinct()


def _files(spark, folder):
    files = _days(spark, folder).groupBy("variable", F.year("date").alias("file")).agg(
        F.count(F.lit(1)).alias("n_steps")
    )
    return ordering.file_offsets(files)


def _axis(spark, folder):
    return merge.axis_positions(_days(spark, folder), "date")


@query("S4 S9 S10 W1 O1", f"WITH {FILES_SQL} SELECT variable, file, n_steps, first_step FROM offs")
def file_offsets(spark, folder):
    return _files(spark, folder)


@query("J3 S7", f"""WITH {FILES_SQL}, {AXIS_SQL} SELECT a.variable, a.idx AS t, a.date, o.file, a.idx - o.first_step AS local_t
    FROM axis a JOIN offs o ON a.variable = o.variable AND a.idx >= o.first_step AND a.idx < o.first_step + o.n_steps""")
def locate_timestep(spark, folder):
    steps = _axis(spark, folder).withColumnRenamed("idx", "t")
    return merge.locate(steps, _files(spark, folder)).select("variable", "t", "date", "file", "local_t")


@query("S6 J4 W3", f"""WITH {AXIS_SQL}, r AS (SELECT idx, date AS ref FROM axis WHERE variable = 'A'),
    n AS (SELECT variable, count(*) AS n_steps FROM axis GROUP BY 1),
    d AS (SELECT a.variable, min(a.idx) AS f FROM axis a LEFT JOIN r ON a.idx = r.idx
      WHERE a.date IS DISTINCT FROM r.ref GROUP BY 1)
    SELECT n.variable, n_steps, (SELECT count(*) FROM r) AS n_reference,
      coalesce(d.f, CASE WHEN n_steps < (SELECT count(*) FROM r) THEN n_steps END) AS first_difference
    FROM n LEFT JOIN d ON n.variable = d.variable""")
def axis_first_difference(spark, folder):
    axis = _axis(spark, folder).withColumn("days", grid.day_number(F.col("date")))
    names = [r.variable for r in axis.select("variable").distinct().collect()]  # the family
    return axes.against_reference(axes.runs(axis, ["variable"]), names, "A")


@query("J5 V3", f"""WITH {AXIS_SQL}, x AS (SELECT idx, max(CASE WHEN variable = 'A' THEN date END) AS a,
      max(CASE WHEN variable = 'N' THEN date END) AS b FROM axis GROUP BY 1)
    SELECT 'time' AS axis, coalesce(bool_and(a = b AND a IS NOT NULL AND b IS NOT NULL), false) AS equal,
      count(a) AS n_left, count(b) AS n_right FROM (SELECT * FROM x WHERE a IS NOT NULL OR b IS NOT NULL)""")
def coordinates_equal(spark, folder):
    axis = _axis(spark, folder).withColumn("axis", F.lit("time"))
    left, right = axis.where("variable = 'A'"), axis.where("variable = 'N'")
    return merge.coordinates_equal(left, right, ["axis", "idx"], "date")


@query("W2", f"""WITH {AXIS_SQL}, s AS (SELECT variable, idx, date, date - lag(date) OVER (PARTITION BY variable ORDER BY idx) AS step FROM axis)
    SELECT variable, idx, date, step FROM s WHERE step <> 1""")
def time_axis_gaps(spark, folder):
    axis = _axis(spark, folder).withColumn("days", grid.day_number(F.col("date")))
    return ordering.axis_gaps(axis).select("variable", "idx", "date", "step")


@query("W4", f"""WITH {FILES_SQL}, c AS (SELECT DISTINCT variable, date_diff('day', DATE '{SHIP_START}', date) // 100 AS k FROM days)
    SELECT variable, count(*) AS n_chunks, min(k) = 0 AND max(k) = count(*) - 1 AS contiguous FROM c GROUP BY 1""")
def time_chunk_contiguity(spark, folder):
    t = F.datediff("date", F.lit(SHIP_START).cast("date"))
    rows = _days(spark, folder).select("variable", grid.block(t, 100).alias("k"))
    return ordering.contiguity(rows, ["variable"], "k")


@query("W8 A16", """WITH x AS (SELECT DISTINCT user_id % 36 AS i, user_id // 36 AS j FROM events)
    SELECT 'lat' AS axis, round(abs(max(CASE WHEN i = 1 THEN 87.5 - 5.0 * i END) - max(CASE WHEN i = 0 THEN 87.5 - 5.0 * i END)), 4)::DOUBLE AS grid_step FROM x
    UNION ALL SELECT 'lon', round(abs(max(CASE WHEN j = 1 THEN -179.75 + 0.5 * j END) - max(CASE WHEN j = 0 THEN -179.75 + 0.5 * j END)), 4)::DOUBLE FROM x""")
def grid_steps(spark, folder):
    from gridcube.sources.tables import lat_of, lon_of

    cells = event_cells(spark, folder)
    lat = cells.select(F.lit("lat").alias("axis"), F.col("i").alias("idx"), lat_of(F.col("i")).alias("label"))
    lon = cells.select(F.lit("lon").alias("axis"), F.col("j").alias("idx"), lon_of(F.col("j")).alias("label"))
    return ordering.grid_step(lat.unionByName(lon), ["axis"], "label")


SMALL = {"time": 1, "lat": 6, "lon": 1}
CHUNK_SQL = EVENTS_SQL + """, manifest AS (SELECT variable, t AS ct, i // 6 AS ci, j AS cj, count(*) AS n_valid,
      CAST(count(*) * 4 AS BIGINT) AS nbytes FROM cells GROUP BY 1, 2, 3, 4)"""


def _manifest(spark, folder):
    return chunks.manifest(event_cells(spark, folder), ["variable"], SMALL)


@query("W5 O3", f"""WITH {CHUNK_SQL} SELECT variable, ct, ci, cj, nbytes,
      row_number() OVER (PARTITION BY variable ORDER BY nbytes, ct, ci, cj) AS rank FROM manifest
    QUALIFY rank <= 3""")
def smallest_chunks(spark, folder):
    order = [F.col(c) for c in ("nbytes", "ct", "ci", "cj")]
    return ordering.smallest_per_group(_manifest(spark, folder), ["variable"], order, 3).select(
        "variable", "ct", "ci", "cj", "nbytes", "rank"
    )


@query("O4", f"""WITH {CHUNK_SQL} SELECT variable, ct, ci, cj FROM manifest WHERE nbytes <= 4
    ORDER BY variable, ct, ci, cj LIMIT 5""")
def first_findings(spark, folder):
    """A report names the first five findings; the limit is the feature."""
    rows = chunks.degenerate(_manifest(spark, folder), 4)
    return rows.orderBy("variable", "ct", "ci", "cj").limit(5).select("variable", "ct", "ci", "cj")


DRAWN_SQL = STRATA_SQL + """, drawn AS (SELECT *, row_number() OVER (PARTITION BY variable, stratum
      ORDER BY md5(concat_ws(':', '20260910', ci, cj)), ci, cj) AS rank FROM strata QUALIFY rank <= 2)"""


def _drawn(spark, folder):
    return ordering.draw(strata(spark, folder), ["variable", "stratum"], ["ci", "cj"], 2, 20260910)


@query("O8 O10", f"WITH {DRAWN_SQL} SELECT variable, stratum, ci, cj, rank FROM drawn")
def stratified_tiles(spark, folder):
    return _drawn(spark, folder).select("variable", "stratum", "ci", "cj", "rank")


@query("W6 O9", f"""WITH {DRAWN_SQL} SELECT variable, ci, cj, stratum,
      row_number() OVER (PARTITION BY variable ORDER BY rank, stratum) AS turn FROM drawn QUALIFY turn <= 3""")
def alternated_tiles(spark, folder):
    return ordering.alternated(_drawn(spark, folder), ["variable"], "stratum", 3).select(
        "variable", "ci", "cj", "stratum", "turn"
    )


@query("W7 O8", f"""WITH {EVENTS_SQL}, g AS (SELECT max(i // 6) AS ni, max(j // 2) AS nj FROM cells),
    v AS (SELECT variable, row_number() OVER (ORDER BY variable) - 1 AS p FROM (SELECT DISTINCT variable FROM cells))
    SELECT variable, CASE WHEN p % 4 < 2 THEN 0 ELSE ni END AS ci, CASE WHEN p % 2 = 0 THEN 0 ELSE nj END AS cj FROM v, g""")
def rotated_corners(spark, folder):
    """Each variable takes the next corner of the tile grid."""
    from pyspark.sql import Window

    extent = event_cells(spark, folder).groupBy("variable").agg(
        F.max(grid.block(F.col("i"), 6)).alias("ni"), F.max(grid.block(F.col("j"), 2)).alias("nj")
    )
    # the windows hold one row per variable of the family
    whole = Window.partitionBy(F.lit(0))
    numbered = extent.withColumn("p", F.row_number().over(whole.orderBy("variable")) - 1)
    ni, nj = F.max("ni").over(whole), F.max("nj").over(whole)
    zero = F.lit(0)
    corner = lambda i, j: F.struct(i.cast("long").alias("ci"), j.cast("long").alias("cj"))
    spot = ordering.rotated(F.col("p"), [corner(zero, zero), corner(zero, F.col("mj")),
                                         corner(F.col("mi"), zero), corner(F.col("mi"), F.col("mj"))])
    return numbered.withColumn("mi", ni).withColumn("mj", nj).select("variable", spot.alias("c")).select("variable", "c.*")


@query("O11", f"""WITH {FILES_SQL}, n AS (SELECT variable, count(*) AS n FROM days GROUP BY 1)
    SELECT DISTINCT variable, CASE WHEN k = 11 THEN n - 1 ELSE CAST(round_even(k * ((n - 1) / CAST(11 AS DOUBLE)), 0) AS BIGINT) END AS t
    FROM n, range(12) r(k)""")
def spread_days(spark, folder):
    lengths = _days(spark, folder).groupBy("variable").agg(F.count(F.lit(1)).alias("n"))
    return lengths.select("variable", F.explode(ordering.spread_positions(F.col("n"), 12)).alias("t"))


@query("O7", f"""WITH {FILES_SQL}, n AS (SELECT variable, count(*) AS n FROM days GROUP BY 1),
    p AS (SELECT variable, n, unnest([0, n - 1, n - 2]) AS t FROM n
      UNION SELECT variable, n, unnest([e - 1, e, e + 1]) AS t FROM n, range(100, 1000000, 100) r(e) WHERE e < n)
    SELECT variable, t FROM p WHERE t >= 0 AND t < n""")
def edge_days(spark, folder):
    lengths = _days(spark, folder).groupBy("variable").agg(F.count(F.lit(1)).alias("n"))
    return lengths.select("variable", F.explode(ordering.edge_positions(F.col("n"), 100)).alias("t"))


@query("O7", f"""WITH {FILES_SQL} SELECT variable, file, first_step - 1 AS last_before, first_step AS first_after
    FROM offs WHERE first_step > 0""")
def file_seams(spark, folder):
    """Both sides of every file seam."""
    inner = _files(spark, folder).where("first_step > 0")
    return inner.select(
        "variable", "file", (F.col("first_step") - 1).alias("last_before"), F.col("first_step").alias("first_after")
    )


@query("X18 X17", f"""WITH {EVENTS_SQL}, n AS (SELECT max(t) + 1 AS n FROM cells), b AS (SELECT DISTINCT variable, t, date, i // 6 AS ci, j // 2 AS cj FROM cells)
    SELECT DISTINCT variable, CASE WHEN ci = 0 THEN format('t={{}} ({{}})', t, strftime(date, '%Y-%m-%d'))
      ELSE format('lat[{{}}:{{}}) lon[{{}}:{{}}) x {{}} steps', ci * 6, least(ci * 6 + 6, 36), cj * 2, cj * 2 + 2, n) END AS label FROM b, n""")
def box_labels(spark, folder):
    cells = event_cells(spark, folder)
    n_steps = cells.agg((F.max("t") + 1).alias("n")).first().n
    boxes = cells.select(
        "variable", "t", "date", grid.block(F.col("i"), 6).alias("ci"), grid.block(F.col("j"), 2).alias("cj")
    ).distinct()
    plane = F.col("ci") == 0
    t0 = F.when(plane, F.col("t")).otherwise(0)
    label = text.box_label(
        t0, F.when(plane, t0 + 1).otherwise(n_steps), F.col("date"),
        F.col("ci") * 6, F.least(F.col("ci") * 6 + 6, F.lit(36)), F.col("cj") * 2, F.col("cj") * 2 + 2,
    )
    return boxes.select("variable", label.alias("label")).distinct()
