"""Cubes laid over ordinary fact tables, so that grid queries run on them.

``events``: a daily grid per event type. A user is a grid position: 36 latitude
rows from north to south, as many longitude columns as there are users for.
``lineitem``: a daily grid per return flag over several years, 36 x 40 positions.
Cell values are whole cents, so sums do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_LAT = 36
EVENT_START = "2024-01-01"
SHIP_START = "1995-01-01"
SHIP_LON = 40


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("long")


def _days_since(date: Column, start: str) -> Column:
    return F.datediff(date, F.lit(start).cast("date")).cast("long")


def event_cells(spark: SparkSession, folder: str, steps: tuple[int, int] | None = None) -> DataFrame:
    """variable, t, i, j, date, cents: one row per non-empty cell.

    ``steps`` is a half-open step range. It is applied to the timestamp, so that it
    reaches the scan; a filter on the derived ``t`` would not.
    """
    date = F.to_date("ts")
    events = table(spark, folder, "events")
    if steps is not None:
        start, stop = (F.date_add(F.lit(EVENT_START).cast("date"), s) for s in steps)
        events = events.where((date >= start) & (date < stop))
    rows = events.select(
        F.col("event_type").alias("variable"), date.alias("date"),
        (F.col("user_id") % N_LAT).alias("i"),
        F.expr(f"user_id div {N_LAT}").alias("j"),
        cents(F.col("value")).alias("cents"),
    )
    cells = rows.groupBy("variable", "date", "i", "j").agg(F.sum("cents").alias("cents"))
    return cells.withColumn("t", _days_since(F.col("date"), EVENT_START))


def ship_cells(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("variable"), F.to_date("l_shipdate").alias("date"),
        (F.col("l_suppkey") % N_LAT).alias("i"), (F.col("l_partkey") % SHIP_LON).alias("j"),
        cents(F.col("l_extendedprice")).alias("cents"),
    )
    cells = rows.groupBy("variable", "date", "i", "j").agg(F.sum("cents").alias("cents"))
    return cells.withColumn("t", _days_since(F.col("date"), SHIP_START))


def lat_of(i: Column) -> Column:
    """Cell-centre latitude of a row, north to south."""
    return F.lit(87.5) - F.lit(5.0) * i


def lon_of(j: Column) -> Column:
    return F.lit(-179.75) + F.lit(0.5) * j


def raw_event_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The event grid as an undecoded source would hold it: FLOAT, with the missing-data
    sentinel in some cells and NaN in some others."""
    value = (
        F.when(F.col("cents") % 7 == 0, F.lit(-999.0))
        .when(F.col("cents") % 11 == 0, F.lit(float("nan")))
        .otherwise(F.col("cents") / 100)
    )
    return event_cells(spark, folder).withColumn("value", value.cast("float"))


# The same cubes for the comparison engine.
EVENTS_SQL = f"""cells AS (
  SELECT event_type AS variable, CAST(ts AS DATE) AS date,
         date_diff('day', DATE '{EVENT_START}', CAST(ts AS DATE)) AS t,
         user_id % {N_LAT} AS i, user_id // {N_LAT} AS j,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM events GROUP BY ALL)"""

SHIPS_SQL = f"""ships AS (
  SELECT l_returnflag AS variable, CAST(l_shipdate AS DATE) AS date,
         date_diff('day', DATE '{SHIP_START}', CAST(l_shipdate AS DATE)) AS t,
         l_suppkey % {N_LAT} AS i, l_partkey % {SHIP_LON} AS j,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM lineitem GROUP BY ALL)"""

RAW_SQL = EVENTS_SQL + """, raw AS (
  SELECT *, CAST(CASE WHEN cents % 7 = 0 THEN -999.0 WHEN cents % 11 = 0 THEN CAST('NaN' AS DOUBLE)
                 ELSE cents / 100.0 END AS FLOAT) AS value FROM cells)"""
