"""Column expressions for cells, tiles and chunks. All of them stay in the JVM.

A cube is a long table of cells ``(variable, t, i, j, value)``: ``t`` counts time
steps from 0, ``i`` rows from north to south, ``j`` columns. A missing cell is a
missing row, NULL, NaN or the raw sentinel; ``decoded`` folds them into NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridcube.functions.fixed import EPOCH, RAW_FILL


def fill() -> Column:
    """The sentinel as FLOAT: compared as DOUBLE it would never equal float data."""
    return F.lit(RAW_FILL).cast("float")


def decoded(value: Column) -> Column:
    """Sentinel and NaN become NULL."""
    return F.when((value != fill()) & ~F.isnan(value), value)


def is_valid(value: Column) -> Column:
    """True where the cell carries data, infinities included."""
    return value.isNotNull() & ~F.isnan(value)


def is_finite(value: Column) -> Column:
    inf = F.lit(float("inf"))
    return is_valid(value) & (F.abs(value.cast("double")) < inf)


def filled(value: Column, constant: float) -> Column:
    """NULL and NaN replaced by a constant."""
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(None)), F.lit(float(constant)))


def block(index: Column, size: int) -> Column:
    """Which block of ``size`` positions an index falls in."""
    return F.floor(index / F.lit(size)).cast("int")


def ceil_div(total: int, size: int) -> int:
    return -(-total // size)


def chunk_columns(chunks: dict[str, int]) -> list[Column]:
    return [
        block(F.col("t"), chunks["time"]).alias("ct"),
        block(F.col("i"), chunks["lat"]).alias("ci"),
        block(F.col("j"), chunks["lon"]).alias("cj"),
    ]


def lat_weight(lat: Column) -> Column:
    """Cells shrink towards the poles by the cosine of latitude."""
    return F.cos(F.radians(lat))


def day_number(date: Column) -> Column:
    return F.datediff(date, F.lit(EPOCH).cast("date")).cast("long")


def day_date(days: Column) -> Column:
    return F.date_add(F.lit(EPOCH).cast("date"), days.cast("int"))


def layout_of(time_chunk: int, n_time: int) -> str:
    """One chunk through the whole record serves series; anything else serves maps."""
    return "temporal" if time_chunk >= n_time else "spatial"


def capitalised(text: Column) -> Column:
    return F.concat(F.upper(F.left(text, F.lit(1))), F.substr(text, F.lit(2)))


def axis_label(long_name: Column, units: Column) -> Column:
    return F.concat(capitalised(long_name), F.lit(" ["), units, F.lit("]"))


def draw_key(seed: int, *columns: Column) -> Column:
    """A seeded, engine-independent random order over rows."""
    parts = [F.lit(str(seed)), *(c.cast("string") for c in columns)]
    return F.md5(F.concat_ws(":", *parts))
