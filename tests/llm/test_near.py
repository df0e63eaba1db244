"""Near-duplicate documents and vectors against brute force, and components of links."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from gridcube.llm import minhash, near_vectors
from gridcube.llm.components import components

from .conftest import awkward, prose


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


@pytest.mark.parametrize("links", [
    [], [(1, 1), (None, 2)], [(k, k + 1) for k in range(40)], [(5, k) for k in range(30)] + [(100, 101), (101, 100)],
    [(random.Random(7).randint(0, 300) * 7 % 301, random.Random(k).randint(0, 300)) for k in range(200)],
])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    sets = Sets()
    for a, b in links:
        if a is not None and b is not None and a != b:
            sets.join(a, b)
    wanted = {x: sets.find(x) for x in list(sets.up) if sets.find(x) != x}
    got = {r["vertex"]: r["component"] for r in components(df, "a", "b").collect()}
    assert {k: v for k, v in got.items() if k != v} == wanted


def shingle_set(text, words):
    split = (text or "").encode().lower().split()
    return {tuple(split[k : k + words]) for k in range(max(1, len(split) - words + 1))} if split else set()


def near_reference(rows, words, percent):
    sets = Sets()
    own = [(d, shingle_set(t, words)) for d, t, *_ in rows]
    named = [(d, s) for d, s in own if d is not None]
    for a, (x, sx) in enumerate(named):
        sets.find(x)
        for y, sy in named[:a]:
            both = len(sx & sy)
            if sx and sy and x != y and 100 * both >= percent * (len(sx) + len(sy) - both):
                sets.join(x, y)
    return sorted(((d, len(s), None if d is None else sets.find(d), d is not None and d == sets.find(d)) for d, s in own), key=repr)


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "kept")) for r in df.collect()), key=repr)


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(docs, words):
    assert found(minhash.near_duplicates(docs, words=words)) == near_reference(awkward(), words, 80)


def drifting(n, seed=3):
    """Copies that each change a few words of an earlier one, so that links do not reach all pairs."""
    draw, rows = random.Random(seed), [prose(1, 120).split()]
    for _ in range(n - 1):
        own = list(draw.choice(rows))
        for _ in range(draw.randint(1, 9)):
            own[draw.randrange(len(own))] = f"w{draw.randint(0, 10**6)}"
        rows.append(own)
    return [(k, " ".join(w), None, None) for k, w in enumerate(rows)]


@pytest.mark.parametrize("block", [768, 16])
def test_group_of_near_copies_in_blocks(make, block):
    rows = drifting(150) + [(1000 + k, prose(k + 50, 100), None, None) for k in range(40)]
    assert found(minhash.near_duplicates(make(rows), words=2, block=block)) == near_reference(rows, 2, 80)


def test_an_id_with_two_texts_has_the_links_of_both(make):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(1, a, None, None), (5, a, None, None), (5, b, None, None), (7, b, None, None), (9, prose(3, 60), None, None)]
    assert {r[0]: r[2] for r in found(minhash.near_duplicates(make(rows), words=2))} == {1: 1, 5: 1, 7: 1, 9: 9}


def test_without_near_copies(docs, make):
    out = minhash.without_near_copies(docs)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}
    stay = [r[0] for r in near_reference(awkward(), 5, 80) if r[3] or r[0] is None]
    assert sorted(map(repr, (r["doc_id"] for r in out.collect()))) == sorted(map(repr, stay))
    assert minhash.near_duplicates(make([])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.8):
        agree = []
        for _ in range(30):
            pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
            both = int(2 * 450 * share / (1 + share))
            x, y = pool[:450], np.concatenate([pool[:both], pool[450 : 900 - both]])
            agree.append((minhash.signature(x) == minhash.signature(y)).mean())
        assert np.mean(agree) == pytest.approx(share, abs=0.05)


# vectors

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("links", T.StringType()), T.StructField("i", T.StringType())])


def vector_rows():
    rng = np.random.default_rng(5)
    rows, number = [], 0
    for label in (0, 1, 2):
        for _ in range(6):
            centre = rng.normal(size=16)
            for spread in (0.05, 0.2, 0.3, 0.35):
                for _ in range(3):
                    rows.append((number, (centre + spread * rng.normal(size=16)).astype(np.float32).tolist(), label))
                    number += 1
    same = rows[0][1]
    rows += [(900 + k, same, 0) for k in range(4)] + [(950, same, 1), (951, same, None), (952, [2 * v for v in same], 0), (953, [1e-30 * v for v in same], 0)]
    rows += [(960, None, 0), (961, [0.0] * 16, 0), (962, [math.nan] + same[1:], 0), (963, [math.inf] + same[1:], 0), (964, [None] + same[1:], 0),
             (965, [], 0), (966, same[:8], 0), (967, [-v for v in same], 0), (None, same, 0), (970, same, 2), (970, same, 2)]
    return rows


def vector_reference(rows, threshold):
    def usable(r):
        i, v, label = r
        return i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)

    good = [(i, np.array(v, float) / max(map(abs, v)), label) for i, v, label in filter(usable, rows)]
    sets, links = Sets(), [0] * len(good)
    for a, (i, x, p) in enumerate(good):
        sets.find(i)
        for b, (j, y, q) in enumerate(good[:a]):
            if p == q and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                links[a] += 1
                links[b] += 1
                sets.join(i, j)
    out = [(i, n, sets.find(i), i == sets.find(i)) for (i, _, _), n in zip(good, links)]
    return sorted(out + [(r[0], 0, r[0], r[0] is not None) for r in rows if not usable(r)], key=repr)


@pytest.mark.parametrize("block", [2048, 7])
def test_near_vectors(spark, block):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], VECTORS)
    got = near_vectors.near_vectors(df, block=block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == vector_reference(rows, 0.93)
    assert near_vectors.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_quantised_bounds_hold_and_spare_most_pairs():
    rng = np.random.default_rng(2)
    x = near_vectors.normalised(rng.normal(size=(300, 64)))
    x = np.concatenate([x, near_vectors.normalised(x[:100] + 0.04 * rng.normal(size=(100, 64)))])
    q, step, error = near_vectors.quantised(x)
    true, rough = x @ x.T, (q * step[:, None]) @ (q * step[:, None]).T
    assert (np.abs(true - rough) <= error[:, None] + error[None, :] * (1 + error[:, None])).all()
    linked, again = near_vectors.links(x, x, 0.93)
    assert (linked == (true >= 0.93)).all() and again < 0.01 * linked.size
