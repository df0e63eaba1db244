"""Whitening of vectors by the leading components of their covariance.

Components become whole numbers, so that sums are exact. Over each distinct vector once, partitions sum
the dimensions and then, with the exact means known, the products of centred components: a row of the matrix per
partition and dimension, folded per row in the cluster. What reaches the driver is the matrix, dimensions squared and
no more, however many vectors there are.

There it is made tridiagonal by Householder reflections. Sturm counts (how many eigenvalues lie below a number is how many
pivots of the shifted matrix are negative) bisect for the leading eigenvalues alone, inverse iteration gives their vectors, those
of eigenvalues that lie close are made orthogonal to each other at every step, and the reflections turn them back.
Means and components are broadcast, and every vector is projected where it lies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcube.llm.common import kept

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
RANK = 1e-11  # eigenvalues below this share of the largest are rounding of zero: such components do not exist
CLOSE = 1e-3  # eigenvalues this near each other, as a share of the largest, form a cluster
EPS = np.finfo(float).eps
LONG = 1 << 63


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Diagonal, off-diagonal and reflections (unit vectors, None where nothing is to reflect) of a symmetric matrix."""
    a = np.array(matrix, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        column = a[k + 1 :, k]
        scale = np.abs(column).max()
        if scale == 0 or not np.abs(column[1:]).any():
            reflections.append(None)
            continue
        v = column / scale
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        image = column - 2 * (v @ column) * v
        a[k + 1 :, k] = a[k, k + 1 :] = image
        a[k + 2 :, k] = a[k, k + 2 :] = 0
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def counts_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each number: the negative pivots of the shifted matrix (Sturm)."""
    tiny = max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0), 1.0) * EPS * EPS
    pivot = diagonal[0] - at
    below = (pivot < 0).astype(int)
    for d, o in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - at - o * o / pivot
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, largest first, all bisected at once until no double lies between their bounds."""
    n = len(diagonal)
    reach = np.concatenate([np.abs(off), [0]]) + np.concatenate([[0], np.abs(off)])
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max()) + np.abs(low).max() * EPS + np.finfo(float).tiny
    high += np.abs(high) * 4 * EPS
    rank = n - 1 - np.arange(k)  # the eigenvalue with so many below it
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = counts_below(diagonal, off, middle) > rank
        low, high = np.where(above, low, middle), np.where(above, middle, high)
    return low + (high - low) / 2


def solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; a zero pivot counts as the smallest that matters."""
    n = len(diagonal)
    least = max(np.abs(diagonal).max(), np.abs(off).max(initial=0)) * EPS + np.finfo(float).tiny
    pivot, over, beyond, x = (np.zeros(n) for _ in range(4))
    here = [diagonal[0] - shift, off[0] if n > 1 else 0.0, 0.0, right[0]]
    for i in range(n - 1):
        below = [off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < n else 0.0, right[i + 1]]
        if abs(here[0]) < abs(below[0]):
            here, below = below, here
        if abs(here[0]) < least:
            here[0] = np.copysign(least, here[0])
        pivot[i], over[i], beyond[i], x[i] = here
        factor = below[0] / here[0]
        here = [below[1] - factor * here[1], below[2] - factor * here[2], 0.0, below[3] - factor * here[3]]
    pivot[-1], x[-1] = here[0] if abs(here[0]) >= least else np.copysign(least, here[0]), here[3]
    for i in range(n - 1, -1, -1):
        x[i] -= (over[i] * x[i + 1] if i + 1 < n else 0) + (beyond[i] * x[i + 2] if i + 2 < n else 0)
        x[i] /= pivot[i]
        if abs(x[i]) > 1e100:  # only the direction matters
            scale = abs(x[i])
            x /= scale
    return x


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, a column per eigenvalue (largest first), by inverse iteration. Vectors of a cluster
    of close eigenvalues are made orthogonal to those before them after every solution."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0))
    draw = np.random.default_rng(n)
    vectors = np.zeros((n, len(values)))
    first = 0
    used = np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * norm:
            first = k
        # equal eigenvalues are told apart by a hair, so that their systems differ
        used = min(value, used - 10 * EPS * norm) if k > first else value
        x = draw.standard_normal(n)
        for _ in range(5):
            x = solved(diagonal, off, used, x / np.sqrt(x @ x))
            x /= np.abs(x).max()
            for _ in range(2):  # twice is enough
                near = vectors[:, first:k]
                x = x - near @ (near.T @ x)
            if not np.abs(x).max() > 1e-8:
                x = draw.standard_normal(n)
        vectors[:, k] = x / np.sqrt(x @ x)
    return vectors


def leading_components(matrix: np.ndarray, k: int, rank: float = RANK) -> tuple[np.ndarray, np.ndarray]:
    """The at most k leading eigenvalues of a covariance that are not rounding of zero, and their unit eigenvectors as columns."""
    n = len(matrix)
    scale = np.abs(matrix).max(initial=0)
    if n == 0 or scale == 0:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, min(k, n))
    values = values[values > rank * values[0]]
    vectors = tridiagonal_vectors(diagonal, off, values)
    for at in range(len(reflections) - 1, -1, -1):
        if (v := reflections[at]) is not None:
            part = vectors[at + 1 :]
            part -= 2 * np.outer(v, v @ part)
    vectors /= np.sqrt((vectors * vectors).sum(axis=0))
    return values * scale, vectors


@dataclass
class Space:
    """What whitens the vectors of one length."""

    n: int
    sums: np.ndarray  # of every dimension, exact
    values: np.ndarray
    vectors: np.ndarray  # a column per component
    trace: float
    identity_error: float | None = None

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n times what each component lies from the mean, exact: whole numbers, Python's where 64 bits do not hold them."""
        most = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums.tolist()), default=0))
        return x * self.n - self.sums if most < LONG >> 2 else x.astype(object) * self.n - self.sums.astype(object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.offsets(x).astype(float) / self.n) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of squared offsets, exact; None where it is beyond a long."""
        d = self.offsets(x)
        if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * max(1, d.shape[1]) < LONG:
            return (d * d).sum(axis=1).tolist()
        return [total if total < LONG else None for total in (sum(v * v for v in row) for row in d.astype(object).tolist())]


def _by_length(batch: pa.RecordBatch, most: int = 1 << 20):
    """(length, rows, their whole numbers as a matrix) of a batch, some megabytes at a time."""
    lists = batch["x"]
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    lengths = np.diff(ends)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = max(1, most // max(1, int(length)))
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            yield int(length), own, flat[ends[own][:, None] + np.arange(length)]


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the vector in whole numbers, of every vector without null or non-finite components."""
    numbers = F.col("embedding").cast("array<double>")
    sound = F.col("embedding").isNotNull() & ~F.exists(numbers, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    # beyond 2^53 a double is whole: such components are held at 2^62, not overflowed
    whole = F.transform(numbers, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(2.0**62)), F.lit(-(2.0**62)))) + SHIFT)
    return vectors.where(sound).select("vec_id", whole.alias("x"))


def totals(fit: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """n and the sums of every dimension, by length of the vectors."""

    def partial(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for length, _, x in _by_length(batch):
                most = int(np.abs(x).max(initial=0)) * len(x)
                sums = x.sum(axis=0) if most < LONG else x.astype(object).sum(axis=0)
                n, before = held.get(length, (0, np.zeros(length, object)))
                held[length] = (n + len(x), before + sums)
        for length, (n, sums) in held.items():
            yield pa.RecordBatch.from_pydict({"length": pa.array([length] * (length + 1), pa.int32()), "dim": pa.array(range(-1, length), pa.int32()),
                                              "total": pa.array([str(v) for v in (n, *sums)], pa.string())})

    rows = fit.mapInArrow(partial, "length int, dim int, total string")
    sums = rows.groupBy("length", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    out: dict[int, tuple[int, np.ndarray]] = {}
    for length in {r["length"] for r in sums}:
        by_dim = {r["dim"]: int(r["total"]) for r in sums if r["length"] == length}
        whole = [by_dim[d] for d in range(length)]
        out[length] = by_dim[-1], np.array(whole, object if any(abs(v) >= LONG for v in whole) else np.int64)
    return out


def products(fit: DataFrame, spaces: dict[int, Space], of) -> dict[int, np.ndarray]:
    """By length, the summed products of ``of(space, x)``, which is centred: a matrix whose rows the cluster folds."""
    shared = fit.sparkSession.sparkContext.broadcast(spaces)

    def partial(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in _by_length(batch):
                centred = of(shared.value[length], x)
                held[length] = held.get(length, 0.0) + centred.T @ centred
        for length, matrix in held.items():
            yield pa.RecordBatch.from_pydict({"length": pa.array([length] * len(matrix), pa.int32()), "dim": pa.array(range(len(matrix)), pa.int32()),
                                              "products": pa.array(matrix.tolist(), pa.list_(pa.float64()))})

    rows = fit.mapInArrow(partial, "length int, dim int, products array<double>")
    cells = rows.select("length", "dim", F.posexplode("products").alias("other", "value"))
    cells = cells.groupBy("length", "dim", "other").agg(F.sum("value").alias("value"))
    lines = cells.groupBy("length", "dim").agg(F.array_sort(F.collect_list(F.struct("other", "value"))).alias("line")).select("length", "dim", "line.value")
    out: dict[int, list] = {}
    for r in sorted(lines.collect(), key=lambda r: (r["length"], r["dim"])):
        out.setdefault(r["length"], []).append(r["value"])
    return {length: np.array(m) for length, m in out.items()}


def spaces_of(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Space]:
    """What whitens vectors of each length, from distinct vectors."""
    spaces = {length: Space(n, sums, np.zeros(0), np.zeros((length, 0)), 0.0) for length, (n, sums) in totals(fit).items()}
    sums = products(fit, spaces, lambda space, x: space.offsets(x).astype(float) / space.n)
    for length, space in spaces.items():
        matrix = sums.get(length, np.zeros((0, 0))) / space.n
        matrix = (matrix + matrix.T) / 2
        space.values, space.vectors = leading_components(matrix, components)
        space.trace = float(np.trace(matrix))
    for length, matrix in products(fit, spaces, Space.whitened).items():
        space = spaces[length]
        space.identity_error = float(np.abs(matrix / space.n - np.eye(len(matrix))).max(initial=0))
    return spaces


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every vector and each of the at
    most ``components`` leading components, numbered from 1.

    A vector that is null or has null or non-finite components gives no rows. The others become whole numbers,
    floor(64 c) + 1,000,000 (held within 2^62), and the distinct ones among them are fitted on: n, their mean, their
    covariance with divisor n. deviation is the exact sum over dimensions of (n x - sum)^2, null beyond a long; whitened is the
    centred vector on the unit component over the root of its eigenvalue; explained that eigenvalue's share of the trace;
    identity_error how far the covariance of the whitened distinct vectors is from the identity. Components whose eigenvalue is
    rounding of zero do not exist, so a table of one distinct vector, like an empty one, gives no rows. Vectors of several
    lengths are whitened apart, each length among its own. Repeated rows, null ids and ids given twice come back as
    often as they are there; other columns are ignored.
    """
    rows = whole_numbers(vectors)
    spaces = spaces_of(kept(rows.select("x").distinct()), components)
    shared = vectors.sparkSession.sparkContext.broadcast(spaces)

    def projected(batches):
        for batch in batches:
            for length, own, x in _by_length(batch):
                space = shared.value[length]
                k = len(space.values)
                if not k:
                    continue
                ids = batch["vec_id"].take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([space.n] * len(own), pa.int64()), pa.array(space.deviations(x), pa.int64()),
                     pa.array(list(space.whitened(x)), pa.list_(pa.float64())), pa.array([(space.values / space.trace).tolist()] * len(own), pa.list_(pa.float64())),
                     pa.array([space.identity_error] * len(own), pa.float64())],
                    ["vec_id", "n", "deviation", "coordinates", "shares", "identity_error"])

    lists = T.ArrayType(T.DoubleType())
    out = T.StructType([rows.schema["vec_id"], *(T.StructField(n, t) for n, t in (
        ("n", T.LongType()), ("deviation", T.LongType()), ("coordinates", lists), ("shares", lists), ("identity_error", T.DoubleType())))])
    placed = rows.mapInArrow(projected, out).select("*", F.posexplode("coordinates").alias("place", "whitened"))
    return placed.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.element_at("shares", F.col("place") + 1).alias("explained"), "identity_error")
