"""What the corpus operators share: reading tables, keeping results, byte-exact helpers.

Every operator takes a DataFrame, picks the columns it names and ignores all others, so
extra columns, whatever their names, do no harm.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcube.session import cut_lineage

TOKENIZER_FILE = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts reach workers some megabytes at a time: rows here are documents, not numbers, and
    Spark's ten thousand of them are a large part of a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def kept(df: DataFrame) -> DataFrame:
    """The rows, computed once, in files that outlive any executor."""
    return cut_lineage(df)


def bucket_of(key: Column, n: int) -> Column:
    """crc32 of the key written as text, modulo n. Null where the key is."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(n))


def crc(values) -> int:
    return zlib.crc32(values) & 0xFFFFFFFF


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    """Where the installed vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batch, most: int = 512):
    """A record batch a few rows at a time, so that a worker holds few texts as Python objects."""
    for at in range(0, batch.num_rows, most):
        yield batch.slice(at, most)


_NOTHING = object()


class Remembered(dict):
    """What ``make`` gave for the keys asked for lately, so that frequent keys are made once.

    Bounded: when ``most`` keys are held they become the older generation, out of which keys that
    are asked for again come back; the generation before it is forgotten.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.pop(key, _NOTHING)
        if value is _NOTHING:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
