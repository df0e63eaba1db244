"""Exact percentiles without gathering a group in one task.

``percentile()`` keeps every distinct value of a group in one buffer, which a hot group does not survive. Here a
mergeable sketch first tells, of every group, values between which a wanted rank surely lies: its error is bounded by a
share of the group's rows, and the bracket is several times as wide. A second pass counts what lies below
each bracket, and the values inside it, both combined map-side. A bracket holds about a hundredth of a group;
where that is still much, the values inside are sketched again, so that no task ever sorts more than a fixed number of
them. Whether each bracket held its rank is checked on the exact counts, and one that did not is opened. Groups
that are no larger than this number to begin with are counted and sorted as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcube.functions.grid import is_finite
from gridcube.session import cut_lineage

STEPS = 500  # quantiles a sketch is asked for
ACCURACY = 10_000  # a sketch is wrong by at most one in so many rows, a twentieth of a step
MARGIN = 2  # steps on either side of the one a rank falls into
SMALL = 20_000  # groups up to here are not bracketed: their values are counted
MOST_INSIDE = 1_000_000  # distinct values in a bracket that one task sorts
BROADCAST_ROWS = 100_000


def _bracketed(sketched: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _place, _lo, _hi): between which values the ranks on either side of ``_place`` lie. ``_place`` counts
    from the first of all values of the group, ``_under`` of which are known to lie below those sketched."""
    def step(rank, rounded, margin):
        return (rounded((rank - F.col("_under")) / F.col("_n") * STEPS) + margin).cast("int")

    first, last = step(F.floor("_place"), F.floor, -MARGIN), step(F.ceil("_place") + 1, F.ceil, MARGIN)
    few = F.col("_n") <= SMALL
    lowest = F.when(few | (first <= 0), F.col("_low")).otherwise(F.get("_q", first))
    highest = F.when(few | (last >= STEPS), F.col("_high")).otherwise(F.get("_q", last))
    return sketched.select(*keys, "_place", lowest.alias("_lo"), highest.alias("_hi"))


def _sketched(rows: DataFrame, keys: list[str]) -> DataFrame:
    quantiles = F.percentile_approx("_v", [k / STEPS for k in range(STEPS + 1)], ACCURACY)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), quantiles.alias("_q"))


def _beside(rows: DataFrame, brackets: DataFrame, by: list[str], n: int) -> DataFrame:
    """Rows with the brackets of their group as one array; broadcast up to a counted number of brackets."""
    gathered = brackets.groupBy(*by).agg(F.collect_list(F.struct("percent", "_lo", "_hi")).alias("_brackets"))
    return rows.join(F.broadcast(gathered) if n <= BROADCAST_ROWS else gathered, by)


def _running(keys: list[str]) -> Column:
    """How many values of the group are at most this one."""
    return F.sum("_times").over(Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))


def _interpolated(values: DataFrame, keys: list[str], groups: list[str]) -> DataFrame:
    """The value at each place, between the two ranks beside it, from values with their running counts."""
    at = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("_v")))
    ends = values.groupBy(*keys, "_place").agg(at(F.floor("_place")).alias("_from"), at(F.ceil("_place")).alias("_to"))
    result = F.col("_from") + (F.col("_to") - F.col("_from")) * (F.col("_place") - F.floor("_place"))
    return ends.select(*groups, "percent", result.alias("value"))


def exact_percentiles(
    df: DataFrame, groups: list[str], value: str, percents: list[float], costly: bool = False
) -> DataFrame:
    """(groups..., percent, value): linear interpolation between closest ranks.

    Only finite values count, as doubles. ``df`` is read to count its groups and to count its values; in between to sketch
    it, where groups are large, and twice more for every time that brackets are narrowed again. ``costly`` says that it is more than a scan: its values are then kept in between.
    """
    by = groups or ["_all"]
    keys = [*by, "percent"]
    rows = df.where(is_finite(F.col(value)))
    if not groups:
        rows = rows.withColumn("_all", F.lit(0))
    rows = rows.select(*by, F.col(value).cast("double").alias("_v"))
    if costly:
        rows = cut_lineage(rows)
    percent = F.explode(F.array(*[F.lit(float(p)) for p in percents]))
    place = F.col("percent") / 100 * (F.col("_n") - 1)
    if (rows.groupBy(*by).count().agg(F.max("count").alias("n")).first().n or 0) <= MOST_INSIDE:
        values = rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_times"))
        whole = values.withColumn("_upto", _running(by)).withColumn("_n", F.sum("_times").over(Window.partitionBy(*by)))
        return _interpolated(whole.select("*", percent.alias("percent")).withColumn("_place", place), keys, groups)
    sketched = _sketched(rows, by).select("*", percent.alias("percent"), F.lit(0).cast("long").alias("_under"))
    brackets = _bracketed(sketched.withColumn("_place", place), keys)
    opened = False  # a bracket that missed is opened for good, so that this ends
    while True:
        brackets = cut_lineage(brackets)
        beside = _beside(rows, brackets, by, brackets.count())
        # a row counts for the brackets it lies in, by its value, and for those above it, without
        places = F.transform(
            F.filter("_brackets", lambda b: F.col("_v") <= b["_hi"]),
            lambda b: F.struct(b["percent"].alias("percent"), F.when(F.col("_v") >= b["_lo"], F.col("_v")).alias("_v")))
        counted = beside.select(*by, F.explode(places).alias("_at")).groupBy(*by, F.col("_at.percent").alias("percent"), F.col("_at._v").alias("_v"))
        counted = cut_lineage(counted.agg(F.count(F.lit(1)).alias("_times")))
        outside = F.col("_v").isNull()
        seen = counted.groupBy(*keys).agg(
            F.coalesce(F.sum(F.when(outside, F.col("_times"))), F.lit(0)).alias("_under"),
            F.coalesce(F.sum(F.when(~outside, F.col("_times"))), F.lit(0)).alias("_inside"), F.count("_v").alias("_different"))
        judged = brackets.join(seen, keys, "left")
        held = (F.coalesce("_under", F.lit(0)) <= F.floor("_place")) & (F.ceil("_place") < F.coalesce(F.col("_under") + F.col("_inside"), F.lit(0)))
        state = judged.agg(F.count_if(~held).alias("missed"), F.max(F.when(held, F.col("_different"))).alias("most")).first()
        if state.missed:
            opened = True
            everything = F.lit(float("inf"))
            brackets = judged.select(*keys, "_place", F.when(held, F.col("_lo")).otherwise(-everything).alias("_lo"), F.when(held, F.col("_hi")).otherwise(everything).alias("_hi"))
        elif (state.most or 0) > MOST_INSIDE and not opened:
            inside = F.explode(F.filter("_brackets", lambda b: F.col("_v").between(b["_lo"], b["_hi"]))).alias("_at")
            again = _sketched(beside.select(*by, "_v", inside).select(*by, "_v", F.col("_at.percent").alias("percent")), keys)
            brackets = _bracketed(again.join(judged.select(*keys, "_place", "_under"), keys), keys)
        else:
            break
    upto = counted.where("_v is not null").withColumn("_upto", _running(keys)).join(judged.select(*keys, "_place", "_under"), keys)
    return _interpolated(upto.withColumn("_upto", F.col("_upto") + F.col("_under")), keys, groups)


def robust_limits(
    df: DataFrame, groups: list[str], value: str, low: float = 2.0, high: float = 98.0,
    symmetric: bool = False, costly: bool = False,
) -> DataFrame:
    """(groups..., vmin, vmax): percentile limits, optionally centred on zero."""
    found = exact_percentiles(df, groups, value, [low, high], costly)
    pick = lambda p: F.max(F.when(F.col("percent") == p, F.col("value")))
    limits = found.groupBy(*groups).agg(pick(low).alias("vmin"), pick(high).alias("vmax"))
    if not symmetric:
        return limits
    bound = F.greatest(F.abs("vmin"), F.abs("vmax"))
    return limits.select(*groups, (-bound).alias("vmin"), bound.alias("vmax"))
