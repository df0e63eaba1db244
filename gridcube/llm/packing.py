"""Best-fit packing of token sequences: patterns by non-negative least squares, then best fit.

What is packed is the histogram of piece lengths, which has at most as many entries as a
sequence has tokens, however many documents there are. Lengths are rounded up to steps; the
patterns of at most three documents that fill a sequence in such steps are enumerated, and
non-negative least squares fits how often each is used to the histogram. Counts are rounded down
and cut to what is there. What no pattern took is packed by best fit, longest first, into the
space the patterns leave and into new sequences. Equal sequences are held as one class with a
count, so the plan grows with the histogram only.

Documents then find their places by rank within their length. Ranks come from counts per
(length, salt) and row numbers within those, so a length that a third of all pieces have is
spread over as many tasks as there are salts.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcube.llm.common import crc, kept, slices, small_batches, tokenizer_path
from gridcube.llm.tokens import encoder, in_parts

LENGTH = 4096
END_ID = 1
STEPS = 256  # steps a sequence is divided into for the patterns
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES_WITH_IDS = PIECES + ", ids array<int>"


def patterns(steps: int = STEPS) -> np.ndarray:
    """All multisets of at most three step counts whose sum is ``steps``; zeros fill up."""
    a, b = np.meshgrid(np.arange(steps + 1), np.arange(steps + 1), indexing="ij")
    c = steps - a - b
    good = (a >= b) & (b >= c) & (c >= 0)
    return np.stack([a[good], b[good], c[good]], axis=1)


def nnls(A: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Lawson and Hanson's active set method: x >= 0 with |Ax - b| least."""
    n = A.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    slope = A.T @ b
    for _ in range(rounds or 3 * A.shape[0]):
        gain = np.where(active, -np.inf, slope)
        best = int(gain.argmax())
        if gain[best] <= 1e-8 * max(1.0, np.abs(b).max()):
            break
        active[best] = True
        while True:
            places = np.flatnonzero(active)
            fit = np.linalg.lstsq(A[:, places], b, rcond=None)[0]
            if fit.min() > 0:
                x[:] = 0
                x[places] = fit
                break
            low = fit <= 0
            ratio = x[places][low] / np.maximum(x[places][low] - fit[low], 1e-300)
            x[places] += ratio.min() * (fit - x[places])
            drop = places[low & (x[places] <= 1e-9 * max(1.0, x.max()))]
            active[drop if len(drop) else places[low][ratio.argmin()]] = False
            x[~active] = 0
            if not active.any():
                break
        slope = A.T @ (b - A @ x)
    return x


class Plan:
    """Classes of equal sequences: how many, what space is left, what lengths they hold."""

    def __init__(self, counts: dict[int, int], length: int = LENGTH, steps: int = STEPS):
        self.length, self.steps = length, min(steps, length)
        self.left = {k: int(v) for k, v in counts.items() if v > 0}
        self.content: list[tuple] = []  # per class: chain of (length, times, what was before)
        self.count: list[int] = []
        self.space: list[int] = []
        if self.left:
            self._patterns()
            self._best_fit()

    def _new(self, count: int, space: int, content) -> int:
        self.content.append(content)
        self.count.append(count)
        self.space.append(space)
        return len(self.count) - 1

    def _patterns(self) -> None:
        step = -(-self.length // self.steps)
        n = -(-self.length // step)
        bins = defaultdict(list)
        for size in sorted(self.left):
            bins[-(-size // step)].append(size)
        have = np.zeros(n + 1)
        for k, sizes in bins.items():
            have[k] = sum(self.left[s] for s in sizes)
        made = patterns(n)
        made = made[((have[made] > 0) | (made == 0)).all(axis=1)]
        if not len(made):
            return
        A = np.zeros((n + 1, len(made)))
        for column in range(3):
            np.add.at(A, (made[:, column], np.arange(len(made))), made[:, column] > 0)
        repeat = nnls(A[1:], have[1:])
        for p in np.argsort(-repeat, kind="stable"):
            wanted = int(repeat[p])
            if wanted < 1:
                break
            self._take([int(k) for k in made[p] if k], wanted, bins)

    def _take(self, slots: list[int], wanted: int, bins) -> None:
        """Fill a pattern with the longest lengths left in its bins, run by run."""
        while wanted:
            sizes = []
            taken: dict[int, int] = defaultdict(int)
            for k in slots:
                size = next((s for s in reversed(bins[k]) if self.left[s] > taken[s]), None)
                if size is None:
                    return
                taken[size] += 1
                sizes.append(size)
            if sum(sizes) > self.length:
                return
            run = min([wanted, *(self.left[s] // t for s, t in taken.items())])
            content = None
            for size, times in taken.items():
                content = (size, times, content)
                self.left[size] -= run * times
            for k in slots:
                while bins[k] and not self.left[bins[k][-1]]:
                    bins[k].pop()
            self._new(run, self.length - sum(sizes), content)
            wanted -= run

    def _best_fit(self) -> None:
        open_: dict[int, list[int]] = defaultdict(list)  # by space left
        spaces: list[int] = []

        def offer(k: int) -> None:
            space = self.space[k]
            if space > 0 and self.count[k]:
                if not open_[space]:
                    insort(spaces, space)
                open_[space].append(k)

        for k in range(len(self.count)):
            offer(k)
        for size in sorted(self.left, reverse=True):
            todo = self.left[size]
            while todo:
                at = bisect_left(spaces, size)
                if at == len(spaces):
                    times = self.length // size
                    full, rest = divmod(todo, times)
                    if full:
                        offer(self._new(full, self.length - times * size, (size, times, None)))
                    if rest:
                        offer(self._new(1, self.length - rest * size, (size, rest, None)))
                    break
                space = spaces[at]
                k = open_[space].pop()
                if not open_[space]:
                    spaces.pop(at)
                times = min(space // size, todo)
                run = min(self.count[k], todo // times)
                self.count[k] -= run
                todo -= run * times
                content = (size, times, self.content[k])
                offer(k)
                offer(self._new(run, space - times * size, content))
            self.left[size] = 0

    @property
    def sequences(self) -> int:
        return sum(self.count)

    def intervals(self) -> dict[str, np.ndarray]:
        """Per length, which ranks go where: key (length and first rank), first sequence, documents
        of that length per sequence, and the offset of the first of them."""
        rows, rank, base = [], defaultdict(int), 0
        for content, count in zip(self.content, self.count):
            if not count:
                continue
            offset, link = 0, content
            while link:
                size, times, link = link
                rows.append((size, rank[size], base, times, offset))
                rank[size] += count * times
                offset += size * times
            base += count
        rows.sort()
        size, lo, first, times, offset = (np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 5
        return {"key": (size << 44) + lo, "lo": lo, "first": first, "times": times, "offset": offset}


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every document's ids and end_id, cut only where there are more than ``length``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        for batch in (part for whole in batches for part in slices(whole)):
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, part in in_parts(texts):
                rows = []
                for key, ids in zip(keys[at : at + len(part)], code.encode(part)):
                    ids = np.append(ids, np.array(end_id, code.dtype)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), length)):
                        own = ids[start : start + length]
                        row = (key, piece, start, len(own), crc(own.tobytes()))
                        rows.append((*row, own.astype(np.int32)) if with_ids else row)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES_WITH_IDS if with_ids else PIECES)


def packed(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID,
           steps: int = STEPS, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece of every document.

    A null or empty text is the end id alone. Pieces of one document may lie in different
    sequences. Rows repeated with their doc_id are packed as often as they occur; a null doc_id is
    kept as null. No documents give no rows. ``with_ids`` adds the piece's ids.
    """
    spark = docs.sparkSession
    cut = kept(pieces(docs, tokenizer or tokenizer_path(), length, end_id, with_ids))
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``length`` rows
    where = Plan(counts, length, steps).intervals()

    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = salted.groupBy("length", "salt").count().select(
        "length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("place", F.row_number().over(within) - 1).join(shifts, ["length", "salt"]).withColumn(
        "rank", (F.col("place") + F.col("shift")).cast("long"))
    columns = [*cut.columns, "rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(where["key"], (size << 44) + rank, "right") - 1
            t = rank - where["lo"][at]
            sequence = where["first"][at] + t // where["times"][at]
            offset = where["offset"][at] + t % where["times"][at] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = (PIECES_WITH_IDS if with_ids else PIECES) + ", sequence_id long, offset long"
    return ranked.select(*columns).mapInArrow(place, schema)
