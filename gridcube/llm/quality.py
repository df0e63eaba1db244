"""Quality by nearest-neighbour voting in a latent semantic space.

A text becomes counts of terms that speak of its form: triples of character classes, repeated
words and lines, word lengths. Counts are damped and weighted by how rare the term is among the
labelled texts, and projected on the leading singular directions of the labelled texts' term
matrix. The labelled vectors, a bounded number of short ones, go to every worker; each block of
documents is multiplied with all of them, exactly, and the nearest vote with their similarity.
A class that was sampled more densely than it occurs votes with correspondingly less weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.llm.common import bucket_of, small_batches
from gridcube.llm.toxicity import labelled

FIT_ROWS = 2000  # labelled rows of each class at most
TERMS = 1024  # terms of the matrix, the most telling apart from constant ones
DIMS = 48
NEIGHBOURS = 25
SHARPNESS = 12.0  # power of the similarity a neighbour votes with
HELD_OUT = 5
THRESHOLD = 0.3

CLASSES = 16


def _class(c: int) -> int:
    s = chr(c)
    return (
        1 if s.islower() and c < 128 else 2 if s.isupper() else 3 if s.isdigit() else 4 if s == "\n" else 5 if s.isspace()
        else 6 if s.isalpha() else 7 if s == "." else 8 if s == "," else 9 if s in "!?" else 10 if s in "|=_-" else 11 if s in "#*~^"
        else 12 if s in "&%$@" else 13 if s in "'\"()[]:;" else 14 if s in "<>{}/\\" else 15)


_near = np.array([_class(c) for c in range(0x3000)], np.uint8)
_far: dict[int, int] = {}  # code points beyond, once seen: at most as many as Unicode has


def classes_of(points: np.ndarray) -> np.ndarray:
    """The class of every code point, by the same rule for all scripts."""
    near = points < len(_near)
    out = _near[np.where(near, points, 0)]
    if not near.all():
        distinct, at = np.unique(points[~near], return_inverse=True)
        for c in distinct.tolist():
            if c not in _far:
                _far[c] = _class(c)
        out[~near] = np.array([_far[c] for c in distinct.tolist()], np.uint8)[at]
    return out


GRAMS = CLASSES**3
EXTRA = 64  # places after the class triples


def counts(text: str | None) -> np.ndarray:
    """Term counts of a whole text."""
    text = text or ""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kinds = classes_of(points).astype(np.int64)
    out = np.zeros(GRAMS + EXTRA)
    if len(kinds) > 2:
        out[:GRAMS] = np.bincount((kinds[:-2] * CLASSES + kinds[1:-1]) * CLASSES + kinds[2:], minlength=GRAMS)
    words = text.lower().split()
    n = len(words)
    for gap in (1, 2, 3, 4):
        out[GRAMS + gap] = sum(map(str.__eq__, words[gap:], words[:-gap]))
    distinct = len(set(words))
    out[GRAMS + 5] = n - distinct
    out[GRAMS + 6 + min(9, int(10 * distinct / max(1, n)))] = n
    lines = text.split("\n")
    out[GRAMS + 16] = len(lines) - len(set(lines))
    out[GRAMS + 17] = len(lines)
    lengths = np.bincount(np.minimum(list(map(len, words)) or [0], 19), minlength=20)
    out[GRAMS + 18 : GRAMS + 38] = lengths
    out[GRAMS + 38 + min(15, n.bit_length())] = max(1, n)
    return out


def rows_of(texts: list) -> np.ndarray:
    """Relative term frequencies, square-rooted, so that a term's length is its share."""
    x = np.array([counts(t) for t in texts], np.float64).reshape(-1, GRAMS + EXTRA)
    total = np.maximum(1, np.maximum(x[:, :GRAMS].sum(axis=1), 1))
    x[:, :GRAMS] /= total[:, None]
    words = np.maximum(1, x[:, GRAMS + 18 : GRAMS + 38].sum(axis=1))
    x[:, GRAMS:] /= words[:, None]
    return np.sqrt(x).astype(np.float32)


class Model:
    def __init__(self, terms, scale, centre, axes, vectors, votes):
        self.terms, self.scale, self.centre, self.axes, self.vectors, self.votes = terms, scale, centre, axes, vectors, votes

    def latent(self, x: np.ndarray) -> np.ndarray:
        z = (x[:, self.terms] * self.scale - self.centre) @ self.axes
        return z / np.maximum(1e-9, np.sqrt((z * z).sum(axis=1)))[:, None]

    def score(self, texts: list, block: int = 512) -> np.ndarray:
        out = np.empty(len(texts))
        for at in range(0, len(texts), block):
            near = self.latent(rows_of(texts[at : at + block])) @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(1e-6, np.take_along_axis(near, best, axis=1).astype(np.float64)) ** SHARPNESS
            label, much = self.votes[0][best], self.votes[1][best]
            out[at : at + block] = (weight * much * label).sum(axis=1) / (weight * much).sum(axis=1)
        return out


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", rows: int = FIT_ROWS) -> Model | None:
    """Learn the space and the voters; None without labels of both classes."""
    small_batches(docs.sparkSession)
    sample = labelled(docs, labels, column, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rows_of(batch.column(1).to_pylist()).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), batch.column(2)], ["_id", "x", "label"])

    got = sample.mapInArrow(count, "_id long, x binary, label int").collect()  # the bounded sample
    y = np.array([r["label"] for r in got], np.float64)
    if len(set(y.tolist())) < 2:
        return None
    order = np.argsort([r["_id"] for r in got], kind="stable")
    x = np.array([np.frombuffer(got[k]["x"], np.float16) for k in order]).astype(np.float32)
    y = y[order]
    whole = {
        r["label"]: r["count"] for r in labels.select(F.col("doc_id").alias("_id"), F.col(column).cast("int").alias("label"))
        .where("_id is not null and label in (0, 1)").where(bucket_of(F.col("_id"), HELD_OUT) != 0).groupBy("label").count().collect()}
    share = np.array([whole[0] / (y == 0).sum(), whole[1] / (y == 1).sum()])
    much = (share / share.max())[y.astype(int)]

    present = (x > 0).mean(axis=0)
    terms = np.sort(np.argsort(-x.var(axis=0), kind="stable")[:TERMS])
    scale = (1 + np.log(1 / np.maximum(present[terms], 1 / len(x)))).astype(np.float32)
    weighted = x[:, terms] * scale
    centre = weighted.mean(axis=0)
    values, axes = np.linalg.eigh((weighted - centre).T @ (weighted - centre))
    axes = axes[:, ::-1][:, :DIMS].astype(np.float32)
    model = Model(terms, scale, centre, axes, None, (y, much))
    model.vectors = model.latent(x).astype(np.float32)
    return model


def quality(docs: DataFrame, labels: DataFrame, column: str = "quality", rows: int = FIT_ROWS,
            threshold: float = THRESHOLD, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of documents, from its whole text.

    A null text counts as empty; empty texts are compared like all others. Without labels of both
    classes every score is 0.5. held_out is null where doc_id is. Rows repeated get equal answers.
    """
    learned = model or fit(docs, labels, column, rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = learned.score(texts) if learned else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id", (bucket_of(F.col("doc_id"), HELD_OUT) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
