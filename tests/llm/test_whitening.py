"""Whitening against dense linear algebra and whole numbers of Python."""

from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry_module
from gridcube.llm import whitening
from gridcube.llm.common import table

FOLDER = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       *(T.StructField(c, T.StringType()) for c in ("x", "n", "component", "place", "length"))])


def frame(spark, rows):
    padded = [tuple(r) + ("x",) * 5 for r in rows]
    return spark.createDataFrame(padded, SCHEMA).repartition(3) if padded else spark.createDataFrame([], SCHEMA)


def matrices():
    draw = np.random.default_rng(0)
    turned, _ = np.linalg.qr(draw.normal(size=(40, 40)))
    few = draw.normal(size=(5, 30))
    return {
        "covariance": np.cov(draw.normal(size=(300, 64)).T), "identity": np.eye(20), "diagonal": np.diag([5.0, 5, 5, 3, 3, 1, 0, 0]), "one": np.array([[3.0]]),
        "two": np.array([[2.0, 1], [1, 2]]), "clusters": turned @ np.diag([7.0] * 10 + [7 - 1e-10] * 10 + [1.0] * 20) @ turned.T,
        "falling": turned @ np.diag(8.0 ** -np.arange(40)) @ turned.T, "low rank": few.T @ few,
        "blocks": np.kron(np.eye(4), [[2.0, 1, 0], [1, 2, 1], [0, 1, 2]]), "tiny": np.eye(5) * 1e-300, "huge": np.eye(5) * 1e300,
        "wilkinson": np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1),
    }


@pytest.mark.parametrize("name", matrices())
def test_leading_components(name):
    v = matrices()[name]
    values, vectors = whitening.leading_components(v, 25)
    true = np.linalg.eigvalsh(v)[::-1]
    assert len(values) == min(25, len(v), int((true > 1e-11 * true[0]).sum()))
    assert np.abs(values - true[: len(values)]).max() <= 1e-14 * true[0] * len(v)
    assert np.abs((v @ vectors - vectors * values) / true[0]).max() <= 1e-13
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13


def test_reflections_and_counts():
    v = matrices()["covariance"]
    d, o, _ = whitening.tridiagonal(v)
    assert np.allclose(np.linalg.eigvalsh(np.diag(d) + np.diag(o, 1) + np.diag(o, -1)), np.linalg.eigvalsh(v), atol=1e-13)
    at = np.linspace(0, 2, 41)
    assert (whitening.counts_below(d, o, at) == (np.linalg.eigvalsh(v)[None, :] < at[:, None]).sum(axis=1)).all()


def checked(rows, got):
    """Every result row against big integers and a dense eigenvalue solver, up to the sign of a component."""
    usable = defaultdict(list)
    for vec_id, e in rows:
        if e is not None and all(c is not None and np.isfinite(c) for c in e):
            usable[len(e)].append((vec_id, tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in e)))
    wanted = 0
    for length, own in usable.items():
        fit = sorted({x for _, x in own})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit]).reshape(n, length)
        cov = centred.T @ centred / n
        e, v = np.linalg.eigh(cov) if length else (np.zeros(0), np.zeros((0, 0)))
        e, v = e[::-1], v[:, ::-1]
        k = min(16, int((e > 1e-11 * e[0]).sum())) if length and e[0] > 0 else 0
        wanted += k * len(own)
        signs = {}
        by_id = defaultdict(list)
        for vec_id, x in own:
            by_id[vec_id].append(x)
        for r in got:
            if r["n"] != n or r["vec_id"] not in by_id or len(by_id[r["vec_id"]]) > 1:
                continue
            x, c = by_id[r["vec_id"]][0], r["component"] - 1
            assert 0 <= c < k
            assert r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums))
            z = np.array([(n * a - s) / n for a, s in zip(x, sums)]) @ v[:, c] / np.sqrt(e[c])
            if abs(z) > 1e-6:
                signs.setdefault(c, set()).add(np.sign(z) == np.sign(r["whitened"]))
            assert abs(abs(z) - abs(r["whitened"])) < 1e-6 * max(1, abs(z))
            assert abs(r["explained"] / (e[c] / e.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-6
        assert all(len(s) == 1 for s in signs.values())
    assert len(got) == wanted


def some(seed=1, n=80, length=24):
    draw = np.random.default_rng(seed)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(draw.normal(size=(n, length)) @ draw.normal(size=(length, length)))]
    rows += [(n, None), (n + 1, [None] + [0.5] * (length - 1)), (n + 2, [float("nan")] + [0.5] * (length - 1)), (n + 3, [float("inf")] * length),
             (n + 4, rows[0][1]), (n + 5, rows[0][1]), (n + 5, rows[0][1]), (None, rows[1][1]), (n + 6, [0.0] * length), (n + 7, []), (n + 8, None)]
    return rows


def test_rows(spark):
    checked(some(), whitening.whitened(frame(spark, some())).collect())


def test_lengths_are_whitened_apart(spark):
    rows = some() + [(1_000 + (k or 0), v) for k, v in some(seed=2, n=30, length=3)]
    checked(rows, whitening.whitened(frame(spark, rows)).collect())


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, [])]):
        assert whitening.whitened(frame(spark, rows)).count() == 0


def test_two_vectors_and_large_components(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 1e30]), (3, [-3e38, 0.0])]
    got = whitening.whitened(frame(spark, rows[:2])).collect()
    assert [r["component"] for r in got] == [1, 1] and all(abs(abs(r["whitened"]) - 1) < 1e-9 and r["deviation"] is None for r in got)
    assert whitening.whitened(frame(spark, rows)).count() == 6


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
def test_query(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "embeddings").select("vec_id", "embedding").collect()]
    checked(rows, entry_module.queries()["op13_whitening"](spark, FOLDER).collect())
