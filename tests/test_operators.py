import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcube.functions import grid, text
from gridcube.functions.names import NameKey
from gridcube.functions.quantiles import exact_percentiles, robust_limits
from gridcube.operators import attrs, chunks, lineage, merge, ordering, reduce, select

NAN, INF = float("nan"), float("inf")


def cells(spark, rows, schema="variable string, t int, i int, j int, value float"):
    return spark.createDataFrame(rows, schema)


def test_missing_values_are_one_state(spark):
    df = spark.createDataFrame([(NAN,), (-999.0,), (None,), (INF,), (-0.0,), (0.1,)], "v float")
    row = df.agg(
        F.count(grid.decoded(F.col("v"))).alias("decoded"), F.count_if(grid.is_valid(F.col("v"))).alias("valid"),
        F.count_if(grid.is_finite(grid.decoded(F.col("v")))).alias("finite"),
        F.count_if(grid.filled(grid.decoded(F.col("v")), -1.0) == -1.0).alias("filled"),
    ).first()
    assert (row.decoded, row.valid, row.finite, row.filled) == (3, 4, 2, 3)


def test_comparison_is_exact_and_knows_nan(spark):
    stored = cells(spark, [("a", 0, 0, 0, 0.1), ("a", 0, 0, 1, 1.0), ("a", 0, 0, 2, -0.0), ("a", 1, 0, 0, 1.0)])
    raw = cells(spark, [("a", 0, 0, 0, 0.1), ("a", 0, 0, 1, float(np.nextafter(np.float32(1), np.float32(2)))),
                        ("a", 0, 0, 2, 0.0), ("a", 0, 0, 3, NAN)])
    row = merge.comparison_totals(merge.compared(stored, raw, ["t", "i", "j"]), []).first()
    assert (row.n_mask_differs, row.n_value_differs, row.n_valid) == (2, 1, 4)


def test_merge_exact_refuses_unequal_axes(spark):
    rows = [(v, t, 0, 0, 1.0) for v in "ab" for t in range(3)]
    assert merge.merge_exact(cells(spark, rows), ["a", "b"], axes=merge.positions(cells(spark, rows))).count() == 3
    with pytest.raises(merge.AxesDiffer, match="'t', at 2"):
        merge.merge_exact(cells(spark, rows[:-1]), ["a", "b"], axes=merge.positions(cells(spark, rows[:-1])))
    # a cell without data is no missing label
    assert merge.merge_exact(cells(spark, rows[:-1]), ["a", "b"], axes=merge.positions(cells(spark, rows))).count() == 3


def test_unknown_names_fail(spark):
    key = NameKey.load().as_table(spark)
    good = spark.createDataFrame([("E",)], "name string")
    assert merge.with_canonical(good, key, "name").first().canonical == "evaporation"
    with pytest.raises(Exception, match="no row in the key for nope"):
        merge.with_canonical(spark.createDataFrame([("nope",)], "name string"), key, "name").collect()
    with pytest.raises(Exception, match="cannot parse version"):
        good.select(text.version_dir(F.lit("4.3a"))).collect()


def test_land_mean_skips_missing(spark):
    rows = [("a", 0, 0, 0, 2.0), ("a", 0, 1, 0, NAN), ("a", 0, 2, 0, 4.0)]
    lat = F.lit(60.0) - F.col("i") * 30
    got = reduce.land_mean(cells(spark, rows), [], lat).first().land_mean
    w = [math.cos(math.radians(60)), math.cos(0)]
    assert got == pytest.approx((2 * w[0] + 4 * w[1]) / sum(w))
    assert reduce.land_mean(cells(spark, [("a", 0, 0, 0, NAN)]), [], lat).first().land_mean is None


@pytest.mark.parametrize("kind", ["float", "double"])
def test_percentiles_match_numpy(spark, kind):
    rng = random.Random(7)
    data = {
        "mixed": [rng.gauss(0, 10) for _ in range(997)], "ties": [float(rng.randrange(4)) for _ in range(500)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-30, 30) for _ in range(400)],
        "one": [3.25], "two": [-1.0, 2.0], "zeros": [0.0, -0.0, 0.0],
        "powers": [2.0 ** k for k in range(-20, 20)] + [-(2.0 ** k) for k in range(-20, 20)],
        "near": [1.0 + k * 2.0 ** -23 for k in range(64)],
    }
    rows = [(g, float(np.float32(v)) if kind == "float" else v) for g, vs in data.items() for v in vs]
    rows += [("mixed", NAN), ("mixed", INF), ("mixed", None)]
    percents = [0.0, 2.0, 37.3, 50.0, 98.0, 100.0]
    df = spark.createDataFrame(rows, f"g string, v {kind}")
    got = {(r.g, r.percent): r.value for r in exact_percentiles(df, ["g"], "v", percents).collect()}
    assert len(got) == len(data) * len(percents)
    for g in data:
        clean = [v for k, v in rows if k == g and v is not None and math.isfinite(v)]
        for p in percents:
            assert got[g, p] == pytest.approx(np.percentile(clean, p), rel=1e-12, abs=1e-300), (g, p)
    whole = exact_percentiles(df, [], "v", [50.0]).first()
    assert whole.value == pytest.approx(np.median([v for _, v in rows if v is not None and math.isfinite(v)]))
    limits = robust_limits(df.where("g = 'two'"), [], "v", 0.0, 100.0, symmetric=True).first()
    assert (limits.vmin, limits.vmax) == (-2.0, 2.0)


def test_smallest_per_group_with_a_hot_group(spark):
    hot = spark.range(5000).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % 5003).alias("v"))
    df = hot.unionByName(spark.createDataFrame([("cold", 5), ("cold", 3)], "g string, v long"))
    got = {(r.g, r["rank"]): r.v for r in ordering.smallest_per_group(df, ["g"], [F.col("v")], 3, salts=4).collect()}
    want = sorted(i * 7919 % 5003 for i in range(5000))[:3]
    assert got == {("hot", 1): want[0], ("hot", 2): want[1], ("hot", 3): want[2], ("cold", 1): 3, ("cold", 2): 5}


def test_draws(spark):
    tiles = spark.range(40).select(F.lit(0).alias("g"), F.col("id").alias("c"))
    pick = lambda seed: {r.c for r in ordering.draw(tiles, ["g"], ["c"], 5, seed).collect()}
    assert pick(1) == pick(1) != pick(2) and len(pick(1)) == 5
    drawn = spark.createDataFrame([("x", "a", 1), ("x", "a", 2), ("x", "a", 3), ("x", "b", 1)], "v string, s string, rank int")
    turns = ordering.alternated(drawn, ["v"], "s", 3).orderBy("turn").collect()
    assert [(r.s, r["rank"]) for r in turns] == [("a", 1), ("b", 1), ("a", 2)]


@pytest.mark.parametrize("n", [1, 2, 7, 16802])
@pytest.mark.parametrize("k", [1, 2, 12])
def test_spread_positions(spark, n, k):
    got = spark.range(1).select(ordering.spread_positions(F.lit(n).cast("long"), k).alias("p")).first().p
    assert got == sorted({int(x) for x in np.linspace(0, n - 1, k).round()})


def test_edge_positions(spark):
    df = spark.createDataFrame([(7,), (3,), (1,)], "n long")
    got = [r.p for r in df.select("n", ordering.edge_positions(F.col("n"), 3).alias("p")).orderBy("n").collect()]
    assert got == [[0], [0, 1, 2], [0, 2, 3, 4, 5, 6]]


def test_gaps_contiguity_locate(spark):
    axis = spark.createDataFrame([("a", 0, 10), ("a", 1, 11), ("a", 2, 14), ("a", 3, 14)], "variable string, idx int, days int")
    assert [(r.idx, r.step) for r in ordering.axis_gaps(axis).orderBy("idx").collect()] == [(2, 3), (3, 0)]
    numbers = spark.createDataFrame([("a", 0), ("a", 1), ("a", 1), ("b", 0), ("b", 2), ("c", 1)], "g string, k int")
    got = {r.g: r.contiguous for r in ordering.contiguity(numbers, ["g"], "k").collect()}
    assert got == {"a": True, "b": False, "c": False}
    files = spark.createDataFrame([("a", "f1", 3), ("a", "f2", 2), ("a", "f3", 0)], "variable string, file string, n_steps long")
    placed = ordering.file_offsets(files)
    steps = spark.range(5).select(F.lit("a").alias("variable"), F.col("id").alias("t"))
    got = [(r.t, r.file, r.local_t) for r in merge.locate(steps, placed).orderBy("t").collect()]
    assert got == [(0, "f1", 0), (1, "f1", 1), (2, "f1", 2), (3, "f2", 0), (4, "f2", 1)]


def test_nearest_and_periods(spark):
    axis = spark.createDataFrame([(0, 10.0), (1, 8.0), (2, 6.0)], "i int, lat double")
    assert select.nearest(axis, "i", "lat", 9.0).first().i == 0  # a tie takes the lower index
    assert select.nearest(axis, "i", "lat", -50.0).first().i == 2
    assert [str(d) for d in select.period("2020-12")] == ["2020-12-01", "2021-01-01"]
    assert [str(d) for d in select.period("2020-02-29")] == ["2020-02-29", "2020-03-01"]
    assert select.sel_descending(axis, "lat", 6, 10).count() == 0


def test_long_chain_depth(spark):
    n = 300
    chain = spark.range(n).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("parent"))
    got = lineage.depth_from_tip(chain, "id", "parent")
    assert got.where(F.col("depth") != F.lit(n - 1) - F.col("id").cast("int")).isEmpty() and got.count() == n


def test_attr_tables(spark):
    schema = "owner string, key string, value string"
    a = spark.createDataFrame([("x", "k", "1"), ("x", "title", "t"), ("x", "gone", "g")], schema)
    b = spark.createDataFrame([("x", "k", "2"), ("x", "title", "u")], schema)
    got = {r.key: r.value for r in attrs.overlaid([a, b]).collect()}
    assert got == {"k": "2", "title": "u", "gone": "g"}
    assert {r.key for r in attrs.differing(a, b, ["title"]).collect()} == {"k", "gone"}
    assert {r.key for r in attrs.lacking(b, ["k", "units"]).collect()} == {"units"}


def test_chunk_round_trip_and_all_fill(spark):
    rows = [("a", t, i, j, float(t * 100 + i * 10 + j)) for t in range(5) for i in range(4) for j in range(3) if (t + i + j) % 3]
    df = cells(spark, rows)
    packed = chunks.packed(df, ["variable"], {"time": 2, "lat": 2, "lon": 2})
    assert chunks.unpacked(packed, ["variable"]).exceptAll(df).isEmpty()
    fills = reduce.all_fill(cells(spark, [("a", 0, 0, 0, -999.0), ("b", 0, 0, 0, -999.0), ("b", 1, 0, 0, NAN)]), ["variable"])
    assert {r.variable: r.all_fill for r in fills.collect()} == {"a": True, "b": False}


def test_block_messages_round_trip(spark):
    df = spark.createDataFrame([("e", 0, 20, 5, 3600)], "variable string, i0 int, i1 int, j0 int, j1 int")
    message = df.select(text.block_message(*map(F.col, df.columns)).alias("m"))
    assert message.first().m == "write e lat[0:20) lon[5:3600)"
    assert tuple(message.select(*text.parsed_block(F.col("m"))).first()) == ("e", 0, 20, 5, 3600)
    other = spark.createDataFrame([("create skeleton",)], "m string").select(*text.parsed_block(F.col("m"))).first()
    assert set(other) == {None}
