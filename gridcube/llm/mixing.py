"""Mixing sources to target weights.

Tokens are summed per source, each source's target follows from the weights, and a document is
emitted floor(rate) times plus once more with the probability of the fraction, drawn from a hash
of its doc_id. One aggregate over documents and one join with the table of sources; the source
that holds a third of all rows is pre-aggregated map-side and its join side is a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
MOST = 3  # times a source's own size
WORD = r"[^\x20\x09-\x0D]+"


def targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST, share: float = 1.0) -> DataFrame:
    """(source, source_size, target) out of rows with source and size.

    Sources in order of code points, null last, take the weights in turn. Together they get
    ``share`` of all sizes; none gets more than ``most`` times its own, and what is cut off goes
    to the others by weight until none is above. With r = most * size / weight, the sources that
    are cut are the smallest in r, so one pass in that order finds them: the level is
    (total - cut sizes) / weights left, and a source is cut while its r is below the level.
    The windows run over one row per source.
    """
    total = Window.partitionBy()
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    by_need = Window.orderBy("need", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    left = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(ordered) - 1).withColumn("weight", weight)
        .withColumn("need", most * F.col("source_size") / F.col("weight"))
        .withColumn("whole", F.sum("source_size").over(total) * F.lit(share))
        .withColumn("before", F.coalesce(F.sum("source_size").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("whole") - most * F.col("before")) / F.col("weights"))
        .withColumn("cut", F.col("need") <= F.col("level"))
    )
    level = F.max(F.when(~F.col("cut"), F.col("level"))).over(total)
    return left.withColumn("final", level).select(
        "source", "source_size",
        F.when(F.col("cut") | F.col("final").isNull(), (most * F.col("source_size")).cast("double"))
        .otherwise(F.col("weight") * F.col("final")).alias("target"),
    )


def mixed(docs: DataFrame, weights=WEIGHTS, most: int = MOST, share: float = 1.0, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, copies, taken for every row of documents.

    size counts runs of anything but ASCII white space; a null text has none. A null source is a
    source of its own. A source without words has rate 0. The draw depends on doc_id alone, so
    reruns agree and repeated rows draw alike; a null doc_id draws as the text 'null'.
    """
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return _drawn(sized, weights, most, share, seed).select("doc_id", "size", "source_size", "target", "copies", "taken")


def _drawn(sized: DataFrame, weights, most, share, seed) -> DataFrame:
    goal = targets(sized, weights, most, share)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}"))
    draw = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / 2.0**32
    return (
        sized.alias("d").join(goal.alias("g"), F.expr("d.source <=> g.source")).drop(F.col("g.source"))
        .withColumn("rate", rate)
        .withColumn("copies", (F.floor("rate") + F.when(draw < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def emitted(docs: DataFrame, weights=WEIGHTS, most: int = MOST, share: float = 1.0, seed: str = "mix") -> DataFrame:
    """Whole rows of documents, each as often as the mix takes it."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    drawn = _drawn(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", size.alias("size")),
                   weights, most, share, seed)
    return drawn.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")


ORACLE = r"""
with s as (select doc_id, source, coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
g as (select source, sum(size)::bigint as source_size from s group by source),
p as (select *, (row_number() over (order by source asc nulls last) - 1) % 3 as place, sum(source_size) over ()::double as whole from g),
w as (select *, case place when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight from p),
n as (select *, 3 * source_size / weight as need from w),
l as (select *, (whole - 3 * coalesce(sum(source_size) over (order by need, source asc nulls last rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by need, source asc nulls last rows between current row and unbounded following) as level from n),
c as (select *, need <= level as cut from l),
t as (select source, source_size, weight, cut, max(case when not cut then level end) over () as final from c),
r as (select source, source_size, case when cut or final is null then (3 * source_size)::double else weight * final end as target from t),
d as (select s.doc_id, s.size, r.source_size, r.target, case when r.source_size > 0 then r.target / r.source_size else 0 end as rate
      from s join r on s.source is not distinct from r.source),
k as (select *, ('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':mix'), 1, 8))::bigint / 4294967296.0::double as draw from d),
m as (select *, (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end)::bigint as copies from k)
select doc_id, size, source_size, target, copies, copies * size as taken from m
"""
