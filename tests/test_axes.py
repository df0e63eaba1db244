"""Runs of axes against plain lists, and the stream that refuses days."""

import random


from gridcube.operators import axes
from gridcube.plans.build import differing_labels
from gridcube.streaming.guard import guard_stream, judged

SCHEMA = "variable string, idx int, days int"


def axis_of(draw, n=60):
    day, out = draw.randrange(5), []
    for idx in range(draw.randint(0, n)):
        out.append((idx, day))
        day += 1 if draw.random() < 0.95 else draw.randint(0, 4)
    return [r for r in out if draw.random() < 0.99]


def test_runs_against_lists(spark):
    draw = random.Random(3)
    held = {f"v{k}": axis_of(draw) for k in range(20)}
    held["same"] = list(held["v0"])
    rows = [(v, i, d) for v, axis in held.items() for i, d in axis]
    found = axes.runs(spark.createDataFrame(rows, SCHEMA).repartition(5), ["variable"]).collect()
    rebuilt = sorted((r.variable, r.first_idx + k, r.first + k) for r in found for k in range(r.n_steps))
    assert rebuilt == sorted(rows) and all(r.last == r.first + r.n_steps - 1 for r in found)
    frame = spark.createDataFrame([tuple(r) for r in found], "variable string, first_idx long, first long, last long, n_steps long")
    got = {r.variable: r for r in axes.against_reference(frame, sorted(held), "v0").collect()}
    base = dict(held["v0"])
    for v, axis in held.items():
        own = dict(axis)
        first = min((i for i in own.keys() | base.keys() if own.get(i) != base.get(i)), default=None)
        assert (got[v].n_steps, got[v].n_reference, got[v].first_difference) == (len(own), len(base), first), v
    one = lambda v: spark.createDataFrame([(i, d) for i, d in held[v]], "idx int, days int")
    assert not differing_labels(one("v0"), one("same"), "days") and differing_labels(one("v0"), one("v1"), "days")
    twice = one("v0").unionByName(one("v0").limit(1))
    assert differing_labels(twice, one("same"), "days") and differing_labels(one("v0"), twice, "days")


def test_absent_ranges(spark):
    draw = random.Random(5)
    held = {f"v{k}": sorted(draw.sample(range(100), draw.randint(1, 100))) for k in range(12)}
    rows = [(v, d, d) for v, days in held.items() for d in days]
    found = axes.runs(spark.createDataFrame(rows, SCHEMA), ["variable"])
    for first, last in ((0, 99), (-3, 120), (40, 41)):
        got = axes.absent(found, first, last).collect()
        assert sorted((r.variable, d) for r in got for d in range(r["first"], r["last"] + 1)) == sorted(
            (v, d) for v, days in held.items() for d in set(range(first, last + 1)) - set(days))
        ends = {(r.variable, r["first"]) for r in got}
        assert not any((r.variable, r["last"] + 1) in ends for r in got)
    assert axes.absent(axes.runs(spark.createDataFrame([], SCHEMA), ["variable"]), 0, 9).count() == 0


def test_judged_days():
    assert judged([5, 6, 6, 8], 5, 5) == ([("accepted", 5), ("accepted", 6), ("doubled", 7), ("early", 7)], 7)
    assert judged([3, 5, 7], 5, 7) == ([("late", 7), ("doubled", 7), ("accepted", 7)], 8)
    assert judged([], 1, 4) == ([], 4)


def test_guard_goes_on_after_a_restart(spark, tmp_path):
    schema, seen = "variable string, days long, part long", []
    for part, days in enumerate([[("a", 4), ("b", 9), ("a", None)], [("a", 5), ("a", 7), ("b", 9)], [("a", 6), ("a", 7), ("a", 3), ("b", 10)]]):
        spark.createDataFrame([(v, d, part) for v, d in days], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        guard_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()  # a new query each time
        seen.append(spark.read.parquet(str(tmp_path / "out")).count())
    assert seen == [2, 5, 9]
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("part", "variable", "days").collect()
    assert [(r.part, r.variable, r.days, r.verdict) for r in got] == [
        (0, "a", 4, "accepted"), (0, "b", 9, "accepted"), (1, "a", 5, "accepted"), (1, "a", 7, "early"), (1, "b", 9, "doubled"),
        (2, "a", 3, "late"), (2, "a", 6, "accepted"), (2, "a", 7, "accepted"), (2, "b", 10, "accepted")]
