"""Chunk tables: what is written where, how large, and what is missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcube.functions.grid import chunk_columns
from gridcube.functions.quantiles import exact_percentiles

CHUNK = ("ct", "ci", "cj")
CELL_BYTES = 4  # one float32 per stored cell


# What a chunk holds, whatever the order of its cells: sums and exclusive or of the cells' 64-bit hashes. The
# halves of the hashes are summed apart, so that a sum has room for two billion cells of a chunk.
DIGEST = ("hash_xor", "hash_low", "hash_high")


def manifest(cells: DataFrame, by: Sequence[str], chunks: dict[str, int], digest: bool = False) -> DataFrame:
    """One row per chunk that holds any cell, with a digest of its cells if asked for. An all-fill chunk has no row."""
    return cells.groupBy(*by, *chunk_columns(chunks)).agg(
        F.count(F.lit(1)).alias("n_valid"),
        (F.count(F.lit(1)) * CELL_BYTES).alias("nbytes"),
        *(digests() if digest else ()),
    )


def digests(of: Column | None = None) -> list[Column]:
    """Aggregates over cells (t, i, j, value), of those alone for which ``of`` is true."""
    whole = F.xxhash64(*(F.col(c).cast("long") for c in ("t", "i", "j")), F.col("value").cast("float"))
    if of is not None:
        whole = F.when(of, whole)
    halves = whole.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(whole, 32)
    return [F.bit_xor(whole).alias(DIGEST[0]), *(F.sum(half).alias(name) for half, name in zip(halves, DIGEST[1:]))]


def folded(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Manifest rows of parts of chunks, or of several chunks, as one per group: counts and digests add up."""
    return rows.groupBy(*by).agg(
        F.sum("n_valid").alias("n_valid"), F.sum("nbytes").alias("nbytes"),
        F.bit_xor(DIGEST[0]).alias(DIGEST[0]), *(F.sum(c).alias(c) for c in DIGEST[1:]),
    )


def unlike(left: DataFrame, right: DataFrame, by: Sequence[str] = CHUNK) -> DataFrame:
    """The chunks of two manifests whose cells are not the same: ``by``, with the cells on either side (0: no such chunk)."""
    other = right.select(*by, *(F.col(c).alias(f"_{c}") for c in ("n_valid", *DIGEST)))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("n_valid", *DIGEST)]
    rows = left.select(*by, "n_valid", *DIGEST).join(other, list(by), "full_outer").where(~reduce(lambda a, b: a & b, same))
    zero = F.lit(0).cast("long")
    return rows.select(*by, F.coalesce("n_valid", zero).alias("n_left"), F.coalesce("_n_valid", zero).alias("n_right"))


def duplicate_chunks(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group: manifest rows, and how many chunks they name more than once."""
    named = rows.groupBy(*by, *CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    return named.groupBy(*by).agg(
        F.sum("_n").alias("n_rows"), F.count_if(F.col("_n") > 1).alias("n_duplicated")
    )


def outside_grid(rows: DataFrame, extent: dict[str, Column | int]) -> DataFrame:
    """Manifest rows whose chunk position the grid does not have."""
    inside = F.lit(True)
    for axis, size in extent.items():
        inside = inside & (F.col(axis) >= 0) & (F.col(axis) < size)
    return rows.where(~inside)


def degenerate(rows: DataFrame, floor: int) -> DataFrame:
    return rows.where(F.col("nbytes") <= floor)


def size_stats(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """min, median, max and sum of chunk sizes per group, all exact."""
    sums = rows.groupBy(*by).agg(
        F.min("nbytes").alias("min_bytes"), F.max("nbytes").alias("max_bytes"),
        F.sum("nbytes").alias("sum_bytes"), F.count(F.lit(1)).alias("n_chunks"),
    )
    middle = exact_percentiles(rows, list(by), "nbytes", [50.0], costly=True).select(
        *by, F.col("value").alias("median_bytes")
    )
    return sums.join(middle, list(by))


def read_cost(rows: DataFrame, by: Sequence[str], chunk_mib: float) -> DataFrame:
    """Chunks a selection touches and what they decompress to."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_chunks")).withColumn(
        "mib", F.round(F.col("n_chunks") * chunk_mib, 4)
    )


def packed(cells: DataFrame, by: Sequence[str], chunks: dict[str, int], value: str = "value") -> DataFrame:
    """Cells as one array per chunk, in (t, i, j) order.

    A group is one chunk, so the configured chunk shape bounds what a task gathers.
    """
    entry = F.struct("t", "i", "j", F.col(value).alias("v"))
    gathered = cells.groupBy(*by, *chunk_columns(chunks)).agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    return gathered.select(
        *by, *CHUNK,
        F.transform("entries", lambda e: e["v"]).alias("values"),
        F.transform("entries", lambda e: F.struct(e["t"].alias("t"), e["i"].alias("i"), e["j"].alias("j")))
        .alias("positions"),
    )


def unpacked(chunk_rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Back from chunk arrays to cells."""
    pairs = F.explode(F.arrays_zip("positions", "values"))
    return chunk_rows.select(*by, pairs.alias("c")).select(
        *by, "c.positions.t", "c.positions.i", "c.positions.j", F.col("c.values").alias("value")
    )
