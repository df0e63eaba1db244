"""Text the engine derives: names, messages, labels, summaries. Columns in, column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridcube.functions.fixed import BLOCK_PATTERN


def version_dir(version: Column) -> Column:
    """'v4.3a' -> 'v_4_3_a'; anything else fails the query."""
    pattern = r"^v(\d+)\.(\d+)([a-z])$"
    bad = F.raise_error(F.concat(F.lit("cannot parse version "), version))
    return F.when(version.rlike(pattern), F.regexp_replace(version, pattern, "v_$1_$2_$3")).otherwise(bad)


def block_message(variable: Column, i0: Column, i1: Column, j0: Column, j1: Column) -> Column:
    return F.format_string("write %s lat[%d:%d) lon[%d:%d)", variable, i0, i1, j0, j1)


def parsed_block(message: Column) -> list[Column]:
    """(variable, i0, i1, j0, j1) of a block message; NULL for any other message."""
    is_block = message.rlike(BLOCK_PATTERN)
    names = ("variable", "i0", "i1", "j0", "j1")
    out = []
    for group, name in enumerate(names, start=1):
        part = F.when(is_block, F.regexp_extract(message, BLOCK_PATTERN, group))
        out.append((part if name == "variable" else part.cast("long")).alias(name))
    return out


def box_label(t0: Column, t1: Column, date: Column, i0: Column, i1: Column, j0: Column, j1: Column) -> Column:
    """A box named along the dimension in which it is narrow."""
    plane = F.format_string("t=%d (%s)", t0, F.date_format(date, "yyyy-MM-dd"))
    tile = F.format_string("lat[%d:%d) lon[%d:%d) x %d steps", i0, i1, j0, j1, t1 - t0)
    return F.when(t1 - t0 == 1, plane).otherwise(tile)


def commit_batch(target: Column, time_chunk: Column) -> Column:
    """Steps per commit: the nearest whole number of chunks, at least one, half to even."""
    return F.greatest(F.lit(1), F.bround(target / time_chunk).cast("long")) * time_chunk
