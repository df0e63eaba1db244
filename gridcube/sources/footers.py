"""What Parquet files say of themselves: rows and extremes, read from their footers alone.

Spark lists the files; tasks open each one's footer, some kilobytes at its end, and return a row per file. No
data page is read, so looking at a whole store or archive costs as many small reads as it has files.

Footers are opened through Arrow's file systems. ``reachable`` says whether they know a path; where they do not,
callers count by scanning columns instead.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTREMES = T.MapType(T.StringType(), T.StructType([T.StructField("low", T.LongType()), T.StructField("high", T.LongType())]))
FOOTERS = T.StructType([
    T.StructField("file_path", T.StringType()), T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("n_rows", T.LongType()), T.StructField("n_groups", T.IntegerType()), T.StructField("extremes", EXTREMES), T.StructField("problem", T.StringType())])


def _opened(path: str):
    """Arrow's file system for a path as Hadoop spells it, and the path there."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def reachable(path: str) -> bool:
    """Whether Arrow knows the file system of a path."""
    try:
        _opened(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_path, path, length) of the Parquet files at or below some paths. Lists, reads nothing.
    ``file_path`` is spelled as scans spell it in ``_metadata.file_path``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(list(paths))
    return found.select(F.col("_metadata.file_path").alias("file_path"), "path", "length")


def footers(files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per listed file: its rows, row groups and the extremes of some integer columns.

    A column that has no statistics in some row group with rows is missing from ``extremes``; a file whose
    footer cannot be read has a ``problem`` and no rows.
    """
    wanted = list(columns)

    def read(path: str) -> tuple:
        import pyarrow.parquet as pq

        try:
            system, place = _opened(path)
            with system.open_input_file(place) as file:
                meta = pq.ParquetFile(file).metadata
        except (pa.ArrowException, OSError, ValueError) as error:
            return None, None, None, str(error).splitlines()[0][:200]
        place_of = {meta.schema.column(k).path: k for k in range(meta.num_columns)}
        found = {}
        for name in wanted:
            ends = [meta.row_group(g).column(place_of[name]).statistics for g in range(meta.num_row_groups) if meta.row_group(g).num_rows] if name in place_of else []
            if ends and all(s is not None and s.has_min_max for s in ends):
                found[name] = {"low": int(min(s.min for s in ends)), "high": int(max(s.max for s in ends))}
        return meta.num_rows, meta.num_row_groups, list(found.items()), None

    kind = pa.map_(pa.string(), pa.struct([("low", pa.int64()), ("high", pa.int64())]))

    def look(batches):
        for batch in batches:
            rows = [read(path) for path in batch["path"].to_pylist()]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch["file_path"], batch["path"], batch["length"], *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), kind, pa.string())))],
                FOOTERS.names)

    return files.select("file_path", "path", "length").mapInArrow(look, FOOTERS)
