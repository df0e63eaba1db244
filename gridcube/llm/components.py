"""Connected components of a link table, by alternating stars.

Each round rewires every vertex to the smallest vertex it can see: first its larger
neighbours (large star), then its smaller ones (small star). Links only ever shrink
towards the smallest vertex of their component, and when a round changes nothing each
component is one star around it. Rounds grow with the logarithm of the longest chain.
A hub's links are never gathered: its minimum is a partial aggregate, and the minimum
comes back by a join that Spark may split where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.llm.common import kept


PER_FILE = 500_000  # links in a kept file; rounds over few links write few files


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, component) for every vertex that has a link; component is the smallest vertex.

    Null ends and self links are ignored. Links may repeat and come either way round.
    """
    edges = kept(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v and u is not null and v is not null").distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(both, both.where("v > u"))
        # in the orientation u > v, v and u itself hang on the smallest v
        edges = kept(_star(edges, edges, centre_too=True).coalesce(1 + mark[0] // PER_FILE))
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))


def _star(seen: DataFrame, moved: DataFrame, centre_too: bool = False) -> DataFrame:
    lowest = seen.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
    rewired = moved.join(lowest, "u").select(F.col("v").alias("x"), "low")
    if centre_too:
        rewired = rewired.union(lowest.select(F.col("u").alias("x"), "low"))
    return rewired.where("x <> low").select(F.greatest("x", "low").alias("u"), F.least("x", "low").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
