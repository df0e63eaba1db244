"""The named queries: each has a Spark side and, where SQL can say it, a DuckDB side."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name. ``covers`` lists operator ids."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return widened(fn(spark, folder))

        REGISTRY[fn.__name__] = Query(fn.__name__, covers, run, sql)
        return fn

    return register


def widened(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, so that both engines report one type."""
    small = {"integer", "short", "byte"}
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("long").alias(f.name) if f.dataType.typeName() in small
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
