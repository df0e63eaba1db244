"""Small documents with every awkward case, and the columns that operators use inside."""

import random

import pytest
from pyspark.sql import types as T

CLASH = ["label", "score", "hash", "component", "size", "row", "keep_id", "digest", "n", "rank", "_digest",
         "_keep", "_ties", "_gone", "own_id", "gone", "ties"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType())] + [T.StructField(c, T.StringType()) for c in CLASH])


def prose(seed, n, parts=("ba", "lo", "mi", "ter", "nu", "ask", "or", "ent")):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(n))


def awkward():
    """(doc_id, text, lang, source): nulls, empty and white texts, copies, near copies, repeated rows."""
    base = [prose(k, 40 + k) for k in range(12)]
    rows = [(k, t, "aa", "s1") for k, t in enumerate(base)]
    rows += [(100 + k, base[0], "aa", "s1") for k in range(5)]  # copies
    rows += [(200 + k, base[1] + f" tail{k}", None, "s2") for k in range(6)]  # near copies
    rows += [(300, None, "aa", None), (301, "", None, "s2"), (302, " \t\n\x0b\x0c\r ", "aa", "s2"), (303, "single", "aa", "S"),
             (304, "a\x1cb   c d", "aa", "é"), (305, "Tokens <|endoftext|> 's 12 日本 é!", "aa", "s1")]
    rows += [(400, base[2], "aa", "s1"), (400, base[2], "aa", "s1")]  # a repeated row
    rows += [(None, base[3], "aa", "s1"), (None, None, None, None)]
    rows += [(500, prose(77, 30_000), "aa", "s3")]  # very long
    return rows


@pytest.fixture(scope="session")
def make(spark):
    def frame(rows, parts=3):
        padded = [tuple(r) + ("x",) * len(CLASH) for r in rows]
        return spark.createDataFrame(padded, SCHEMA).repartition(parts) if padded else spark.createDataFrame([], SCHEMA)

    return frame


@pytest.fixture(scope="session")
def docs(make):
    return make(awkward()).cache()
