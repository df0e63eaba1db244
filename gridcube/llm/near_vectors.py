"""Near-duplicate vectors by quantised tile products with rigorous error bounds.

Vectors of a label are normalised in double precision and quantised to eight bits, each with its
own scale and with the exact length of what quantising took away. For unit vectors x, y with
quantised x', y' and errors e, f, the true product lies within |e| + |f| * (1 + |e|) of x'y'. A
label's vectors are dealt to blocks of bounded size, and a task takes one pair of blocks (a tile):
the product of the quantised blocks is one matrix product of small integers, exact in float32
(float64 beyond 1024 dimensions). Pairs whose interval lies above the threshold are links, pairs
whose interval lies below are none, and only what is between is computed again in full precision.

No pair leaves a tile. A tile returns, per vector, how many links it has there and the smallest
vector it reaches, so the result has at most two blocks of rows however dense the links are. Equal
vectors of a label are one class with a count and are compared once. The blocks of a label that
has a third of all vectors are as large as any others; it has more tiles.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.llm.common import kept
from gridcube.llm.components import components
from gridcube.llm.minhash import forest

THRESHOLD = 0.93
BLOCK = 2048
SLACK = 1e-12  # rounding of the bounds themselves, far above what float64 loses over these sums


def normalised(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by their largest component first, so that nothing over- or underflows."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eight-bit components, their scale, and the length of the error, per vector."""
    step = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / step[:, None]).astype(np.int8)
    error = unit - q * step[:, None]
    return q, step, np.sqrt((error * error).sum(axis=1)) * (1 + SLACK) + SLACK


def links(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, int]:
    """Which rows of x and y have cosine >= threshold, and how many pairs needed full precision."""
    (qx, sx, ex), (qy, sy, ey) = quantised(x), quantised(y)
    exact = np.float32 if x.shape[1] <= 1024 else np.float64
    rough = (qx.astype(exact) @ qy.astype(exact).T).astype(np.float64) * sx[:, None] * sy[None, :]
    bound = ex[:, None] + ey[None, :] * (1 + ex[:, None]) + SLACK
    linked = rough - bound >= threshold
    a, b = np.nonzero((rough + bound >= threshold) & ~linked)
    for at in range(0, len(a), 1 << 16):
        i, j = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        linked[i, j] = (x[i] * y[j]).sum(axis=1) >= threshold
    return linked, len(a)


def _tile(threshold: float):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        same = group["i"].iat[0] == group["j"].iat[0]
        first = group["own"] == group["i"]
        sides = (group, group) if same else (group[first], group[~first])
        if not len(sides[0]) or not len(sides[1]):
            return pd.DataFrame({"class_id": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})
        unit = [normalised(np.stack(side["embedding"].to_numpy()).astype(np.float64)) for side in sides]
        ids, many = ([side[c].to_numpy(np.int64) for side in sides] for c in ("class_id", "copies"))
        linked, _ = links(*unit, threshold)
        if same:
            linked |= linked.T  # both roundings of one product
            np.fill_diagonal(linked, False)
        roots = forest(*ids, linked)
        out = pd.DataFrame({"class_id": ids[0], "links": linked @ many[1], "root": roots[0]})
        if not same:
            out = pd.concat([out, pd.DataFrame({"class_id": ids[1], "links": many[0] @ linked, "root": roots[1]})])
        return out[out["links"] > 0]

    return compare


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row with vec_id, embedding and label.

    Two vectors are linked when their labels are equal and not null and their cosine is at least
    ``threshold``. A vector that is null, empty or zero, has null or non-finite components, or
    has no label links with nothing, and so do vectors of different lengths. n_links counts the
    other rows that are linked directly, equal vectors among them; component_id is the smallest
    vec_id that links reach. A row without vec_id links with nothing, has no component and is not
    kept. An id given to several vectors is one vector with the links of each. No rows give no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda c: c != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.where("usable")
    classes = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"))
    classes = kept(classes.withColumn("dims", F.size("embedding")))
    blocks = classes.groupBy("label", "dims").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = (
        classes.join(blocks, ["label", "dims"])
        .withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("label", "dims", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class_id", "copies", "embedding")
    )
    found = kept(dealt.groupBy("label", "dims", "i", "j").applyInPandas(_tile(threshold), "class_id long, links long, root long"))
    direct = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    reach = components(found, "class_id", "root").toDF("class_id", "component")

    member = good.select("vec_id", "label", "embedding").join(classes.drop("dims"), ["label", "embedding"]).select(
        "vec_id", "class_id", "copies").join(direct, "class_id", "left").join(reach, "class_id", "left")
    linked = member.select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))



ORACLE = """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as e,
    vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0 as usable
  from embeddings),
l as (
  select a.vec_id as x, b.vec_id as y from v a join v b
    on a.label = b.label and a.vec_id <> b.vec_id and a.usable and b.usable and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (select vec_id as x, vec_id as y from v where usable union select r.x, l.y from reach r join l on l.x = r.y),
c as (select x, min(y) as component_id from reach group by x),
n as (select x, count(*) as n_links from l group by x)
select v.vec_id, coalesce(n.n_links, 0) as n_links, coalesce(c.component_id, v.vec_id) as component_id,
  coalesce(v.vec_id = coalesce(c.component_id, v.vec_id), false) as kept
from v left join c on c.x = v.vec_id left join n on n.x = v.vec_id
"""
