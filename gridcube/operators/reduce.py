"""Aggregations over cells. All combine map-side before their shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcube.functions.grid import block, fill, is_valid, lat_weight


def weighted_mean(value: Column, weight: Column) -> Column:
    """Missing cells leave both sums, so the mean is over the cells that carry data."""
    seen = is_valid(value)
    return F.sum(F.when(seen, value * weight)) / F.sum(F.when(seen, weight))


def land_mean(cells: DataFrame, by: Sequence[str], lat: Column, value: str = "value") -> DataFrame:
    """Area-weighted mean per group; no group columns give the overall mean."""
    mean = weighted_mean(F.col(value).cast("double"), lat_weight(lat)).alias("land_mean")
    return cells.groupBy(*by).agg(mean) if by else cells.agg(mean)


def time_mean(cells: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Mean over time per position, missing steps skipped."""
    v = F.col(value).cast("double")
    return cells.groupBy(*by).agg(F.avg(F.when(is_valid(v), v)).alias("time_mean"))


def annual_mean(cells: DataFrame, by: Sequence[str], value: str = "value", date: str = "date") -> DataFrame:
    """Mean per calendar year, labelled with the year's last day."""
    v = F.col(value).cast("double")
    return (
        cells.groupBy(*by, F.year(date).alias("_year"))
        .agg(F.avg(F.when(is_valid(v), v)).alias("annual_mean"))
        .select(*by, F.make_date("_year", F.lit(12), F.lit(31)).alias("year_end"), "annual_mean")
    )


def component_shares(wide: DataFrame, total: str, components: Sequence[str], lat: Column) -> DataFrame:
    """(component, land_mean, share_pct): each component over the total's footprint.

    Means over each component's own footprint would cover different areas and the
    shares would not add up, so cells without the total are left out first. The
    last rows are the sum of the components and the total itself.
    """
    weight = lat_weight(lat)
    on_footprint = wide.where(is_valid(F.col(total).cast("double")))
    means = on_footprint.agg(
        *[weighted_mean(F.col(n).cast("double"), weight).alias(n) for n in (total, *components)]
    )
    listed = F.array(*[F.struct(F.lit(n).alias("component"), F.col(n).alias("land_mean")) for n in components])
    summed = F.struct(
        F.lit("sum of components").alias("component"),
        sum((F.coalesce(F.col(n), F.lit(0.0)) for n in components[1:]),
            F.coalesce(F.col(components[0]), F.lit(0.0))).alias("land_mean"),
    )
    own = F.struct(F.lit(total).alias("component"), F.col(total).alias("land_mean"))
    return (
        means.select(F.col(total).alias("_total"), F.explode(F.concat(listed, F.array(summed, own))).alias("r"))
        .select("r.component", "r.land_mean", (100 * F.col("r.land_mean") / F.col("_total")).alias("share_pct"))
    )


def footprint_excess(wide: DataFrame, total: str, components: Sequence[str]) -> DataFrame:
    """Per component, how many cells it has where the total has none."""
    lacking = ~is_valid(F.col(total).cast("double"))
    counts = wide.agg(
        *[F.count_if(is_valid(F.col(n).cast("double")) & lacking).alias(n) for n in components]
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("component"), F.col(n).alias("n_excess")) for n in components])
    return counts.select(F.explode(pairs).alias("r")).select("r.*")


def tile_valid_counts(
    cells: DataFrame, by: Sequence[str], lat: int, lon: int, value: str = "value"
) -> DataFrame:
    """Held cells of raw data per tile of ``lat`` x ``lon`` cells: all but the sentinel. A raw NaN
    counts as held, as it is not what the source writes where there is no data."""
    tiles = [block(F.col("i"), lat).alias("ci"), block(F.col("j"), lon).alias("cj")]
    return cells.groupBy(*by, *tiles).agg(
        F.count_if(F.col(value).cast("float") != fill()).alias("n_valid")
    )


def land_strata(counts: DataFrame, cells_per_tile: Column | int) -> DataFrame:
    """Adds ``stratum``: covered, coastal or empty, by how much of a tile is valid."""
    n = F.col("n_valid")
    return counts.withColumn(
        "stratum",
        F.when(n == cells_per_tile, "covered").when(n > 0, "coastal").otherwise("empty"),
    )


def value_ranges(cells: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    v = F.col(value).cast("double")
    finite = F.when(is_valid(v) & (F.abs(v) < float("inf")), v)
    return cells.groupBy(*by).agg(
        F.count(finite).alias("n_valid"), F.min(finite).alias("low"), F.max(finite).alias("high")
    )


def residual(total: Column, components: Sequence[Column]) -> Column:
    """|total - (a + b + ...)| in the columns' own precision, left to right."""
    summed = components[0]
    for component in components[1:]:
        summed = summed + component
    return F.abs(total - summed)


def residual_totals(rows: DataFrame, by: Sequence[str], residual_column: str, tolerance: Column) -> DataFrame:
    r = F.col(residual_column)
    return rows.groupBy(*by).agg(
        F.count(r).alias("n_tested"), F.max(r).alias("worst"),
        F.count_if(r > tolerance).alias("n_over"),
    )


def all_fill(raw: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Per group: is every raw cell the sentinel?"""
    return raw.groupBy(*by).agg(
        F.bool_and(F.col(value).cast("float") == F.lit(-999.0).cast("float")).alias("all_fill")
    )


def tally(checks: DataFrame) -> DataFrame:
    """Checks and failures per phase. A check that could not be decided has failed."""
    return checks.groupBy("phase").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.coalesce(F.col("ok"), F.lit(False))).alias("n_failed"),
    )


def period_difference(
    cells: DataFrame, by: Sequence[str], first: tuple, second: tuple, value: str = "value",
    date: str = "date",
) -> DataFrame:
    """Mean of one half-open date range minus the mean of another, in a single pass."""
    v = F.col(value).cast("double")
    within = lambda r: (F.col(date) >= F.lit(r[0])) & (F.col(date) < F.lit(r[1]))
    mean = lambda r: F.avg(F.when(within(r) & is_valid(v), v))
    return (
        cells.where(within(first) | within(second))
        .groupBy(*by)
        .agg(mean(first).alias("first_mean"), mean(second).alias("second_mean"))
        .withColumn("difference", F.col("first_mean") - F.col("second_mean"))
    )


def coverage(cells: DataFrame, by: Sequence[str], lat: Column, lon: Column, date: str = "date") -> DataFrame:
    """Extents in time and space, rounded finer than the grid and coarser than float error."""
    return cells.groupBy(*by).agg(
        F.date_format(F.min(date), "yyyy-MM-dd").alias("time_coverage_start"),
        F.date_format(F.max(date), "yyyy-MM-dd").alias("time_coverage_end"),
        F.round(F.min(lat), 4).alias("geospatial_lat_min"),
        F.round(F.max(lat), 4).alias("geospatial_lat_max"),
        F.round(F.min(lon), 4).alias("geospatial_lon_min"),
        F.round(F.max(lon), 4).alias("geospatial_lon_max"),
    )
