"""MinHash near-duplicates: circulant signatures, banding, exact Jaccard on full sets.

A document is the set of its distinct word shingles, held as 64-bit hashes. Two permutations make
all coordinates: the first sends a shingle to a place on a ring, and coordinate k is the smallest
value that the second permutation, shifted by k, gives to the places. The K values a place yields
are one contiguous slice of the second permutation, so a signature is the minimum of slices.

Documents of equal sets form one class; everything after works on one row per class. Bands of
ROWS coordinates deal classes to buckets, and candidates are confirmed on full sets:

1. Each bucket's members are compared with its smallest member. Different bands have different
   smallest members, so this joins nearly all of a group at one comparison per member and band.
2. Buckets in which members other than the smallest still lie in different components are taken
   up whole: cut into blocks, and block against block, the sizes of all intersections are counted
   by matrix products over shared shingles. Only a spanning forest of the links leaves a task.

So every pair of classes that shares a bucket is compared unless it is already connected, which
is all that components depend on; no group's pairs are ever written out. A pair at similarity s
misses all buckets with probability (1 - s^ROWS)^BANDS: 3e-6 at 0.8, 7e-9 at 0.85.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.llm.common import Remembered, kept, slices, small_batches
from gridcube.llm.components import components

ROWS, BANDS = 5, 32
RING = 1 << 20
BLOCK = 768  # classes of a bucket compared as one block
BLOCK_SHINGLES = 1 << 20  # and the shingles of a block
WORDS_KNOWN = 100_000

_rings: dict = {}
_words = Remembered(xxhash.xxh3_64_intdigest, WORDS_KNOWN)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Fewer words than a shingle
    has are one shingle, no words are none.
    """
    split = (text or "").encode().lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, split), np.uint64, len(split))
    if len(h) < words:
        h = np.append(h, np.zeros(words - len(h), np.uint64))
    n = len(h) - words + 1
    out = np.full(n, np.uint64(min(len(split), words)))
    with np.errstate(over="ignore"):
        for k in range(words):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out)


def _ring(coordinates: int) -> np.ndarray:
    """Slices of the second permutation: row p holds its values at places p, p+1, .., p+K-1."""
    if coordinates not in _rings:
        second = np.random.default_rng(20240229).permutation(RING).astype(np.uint32)
        _rings[coordinates] = np.lib.stride_tricks.sliding_window_view(np.append(second, second[: coordinates - 1]), coordinates)
    return _rings[coordinates]


def signature(hashes: np.ndarray, coordinates: int = ROWS * BANDS) -> np.ndarray:
    """The circulant MinHash of a non-empty set."""
    ring, low = _ring(coordinates), np.full(coordinates, np.iinfo(np.uint32).max, np.uint32)
    places = (_mix(hashes ^ np.uint64(0x27D4EB2F165667C5)) & np.uint64(RING - 1)).astype(np.int64)
    for at in range(0, len(places), 4096):
        low = np.minimum(low, ring[places[at : at + 4096]].min(axis=0))
    return low


def band_hashes(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    parts = sig.reshape(-1, rows).astype(np.uint64)
    out = np.arange(len(parts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(rows):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return out.view(np.int64)


def signed(docs: DataFrame, words: int, rows: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, set_key (a digest of the whole set, null for none), bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts, sizes, keys, found = batch.column(1).to_pylist(), [], [], []
            for text in texts:
                own = shingles(text, words)
                sizes.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                found.append(band_hashes(signature(own, rows * bands), rows) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sign, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(class_id, set_key, hashes) of the wanted sets: rows whose doc_id is the class_id and whose
    set has that digest."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            sets = [shingles(text, words).tobytes() for text in batch.column(1).to_pylist()]
            right = pa.array([xxhash.xxh3_128_digest(own) == key for own, key in zip(sets, batch.column(2).to_pylist())], pa.bool_())
            columns = [batch.column(0), batch.column(2), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.filter(right) for c in columns], ["class_id", "set_key", "hashes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("class_id"), "text").join(wanted, "class_id")
    return rows.select("class_id", "text", "set_key").mapInArrow(build, "class_id long, set_key binary, hashes binary")


def _overlap(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by 0/1 matrix products over the shingles on both sides."""
    flat_l, flat_r = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(flat_l, flat_r)
    rows_l, rows_r = np.repeat(np.arange(len(left)), [len(x) for x in left]), np.repeat(np.arange(len(right)), [len(x) for x in right])

    def placed(flat, rows):
        if not len(shared):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(shared, flat)
        hit = shared[np.minimum(at, len(shared) - 1)] == flat
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], rows[hit][order]

    (col_l, row_l), (col_r, row_r) = placed(flat_l, rows_l), placed(flat_r, rows_r)
    total = np.zeros((len(left), len(right)), np.float32)  # counts below 2^24 are exact
    width = 2048
    for at in range(0, len(shared), width):
        a, b = np.searchsorted(col_l, (at, at + width))
        c, d = np.searchsorted(col_r, (at, at + width))
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        x[row_l[a:b], col_l[a:b] - at] = 1
        y[row_r[c:d], col_r[c:d] - at] = 1
        total += x @ y.T
    return total


def forest(left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest label that each row and each column reaches through a matrix of links."""
    low, high, none = left.copy(), right.copy(), np.iinfo(left.dtype).max
    while True:
        before = low.sum(dtype=object), high.sum(dtype=object)
        low = np.minimum(low, np.where(linked, high[None, :], none).min(axis=1))
        high = np.minimum(high, np.where(linked, low[:, None], none).min(axis=0))
        if (low.sum(dtype=object), high.sum(dtype=object)) == before:
            return low, high


def _compared(percent: int):
    def compare(group: pa.Table) -> pa.Table:
        """One pair of blocks of a bucket: links between different components, as a forest."""
        i, j, own, ids, comp = (group.column(c).to_numpy() for c in ("i", "j", "own", "class_id", "component"))
        sets = np.empty(len(own), object)
        sets[:] = [np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()]
        rows = np.arange(len(own))
        first, second = (rows, rows) if i[0] == j[0] else (rows[own == i], rows[own != i])
        low = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(first) and len(second):
            size = np.array([len(s) for s in sets], np.float64)
            both = _overlap(list(sets[first]), list(sets[second])).astype(np.float64)
            linked = 100 * both >= percent * (size[first][:, None] + size[second][None, :] - both)
            linked &= comp[first][:, None] != comp[second][None, :]
            low = np.concatenate([ids[first], ids[second]]), np.concatenate(forest(ids[first], ids[second], linked))
        a, b = (side[low[0] != low[1]] for side in low)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def linked_classes(docs: DataFrame, classes: DataFrame, words: int, percent: int, repeated: bool = True,
                   block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(vertex, component) over classes that link to another one.

    ``classes``: class_id, n_shingles, set_key, bands. ``repeated`` says that rows of documents
    may be repeated with their doc_id.
    """
    bucketed = classes.select("class_id", "n_shingles", F.explode("bands").alias("hash"))  # the hash names its band
    shared = bucketed.groupBy("hash").agg(
        F.count("*").alias("members"), F.min("class_id").alias("centre"), F.sum("n_shingles").alias("shingles")).where("members > 1")
    members = kept(bucketed.join(shared, "hash").drop("n_shingles"))
    wanted = members.select("class_id").distinct().join(classes.select("class_id", "set_key"), "class_id")
    sets = sets_of(docs, wanted, words)
    sets = kept((sets.dropDuplicates(["class_id", "set_key"]) if repeated else sets).drop("set_key"))

    pairs = members.where("class_id <> centre").select("class_id", "centre").distinct()
    joined = (
        pairs.join(sets.withColumnRenamed("hashes", "own"), "class_id")
        .join(sets.select(F.col("class_id").alias("centre"), F.col("hashes").alias("other")), "centre")
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y, n = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), 0
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    n = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * n >= percent * (len(x) + len(y) - n))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    stars = kept(joined.select("class_id", "centre", "own", "other").mapInArrow(confirm, "a long, b long"))
    first = components(stars, "a", "b")

    placed = members.where("members > 2 and class_id <> centre").join(
        first.withColumnRenamed("vertex", "class_id"), "class_id", "left").withColumn("component", F.coalesce("component", "class_id"))
    placed = kept(placed)
    open_ = placed.groupBy("hash").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    blocks = F.ceil(F.greatest(F.col("members") / block, F.col("shingles") / block_shingles)).cast("int")
    rest = placed.join(open_.select("hash"), "hash").withColumn("blocks", blocks).withColumn(
        "own", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = rest.select("class_id", "component", "hash", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    late = tiles.join(sets, "class_id").groupBy("hash", "i", "j").applyInArrow(_compared(percent), "a long, b long")
    return components(stars.union(kept(late)), "a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS,
                    block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, kept for every row of documents.

    Two documents are linked when 100 * intersection >= percent * union of their shingle sets.
    class_id is the smallest doc_id with the same set, component_id the smallest that links reach.
    A document without words has no set, links with nothing and is its own component. A row
    without doc_id links with nothing either, its class and component are null and it is not
    kept. Rows repeated with their doc_id are one document and get the same answer; an id given to
    different texts is one document that has the links of each. No rows give no rows.
    """
    own = kept(signed(docs, words, rows, bands))
    has = own.where("doc_id is not null and set_key is not null")
    classes = kept(has.groupBy("set_key").agg(
        F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")))
    again = has.groupBy("doc_id").agg(F.count("*").alias("n"), (F.min("set_key") != F.max("set_key")).alias("differ")).where("n > 1")
    seen = again.agg(F.count("*").alias("n"), F.count(F.when(F.col("differ"), 1)).alias("differ")).first()
    reach = linked_classes(docs, classes, words, percent, seen["n"] > 0, block, block_shingles)
    if seen["differ"]:
        several = has.join(again.where("differ").select("doc_id"), "doc_id").join(classes, "set_key").select(
            F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
        reach = components(reach.toDF("a", "b").union(several), "a", "b")
    class_of = classes.select("set_key", "class_id").join(reach.withColumnRenamed("vertex", "class_id"), "class_id", "left")
    out = own.drop("bands").join(class_of, "set_key", "left")
    named = F.col("doc_id").isNotNull()
    component = F.coalesce("component", "class_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", F.when(named, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(named, component).alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def without_near_copies(docs: DataFrame, **settings) -> DataFrame:
    """Whole rows of documents, one per component: that of the smallest doc_id. Documents
    without words and rows without doc_id stay."""
    gone = near_duplicates(docs, **settings).where("not kept and doc_id is not null").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("own_id"))
    return rows.join(gone, F.col("own_id") == F.col("gone"), "left_anti").select("row.*")


ORACLE = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
    else list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) end) as g
  from d),
n as (select doc_id, count(*) as n_shingles from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as both from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
l as (
  select p.x, p.y from p join n a on a.doc_id = p.x join n b on b.doc_id = p.y
  where 100 * p.both >= 80 * (a.n_shingles + b.n_shingles - p.both)),
reach as (select doc_id as x, doc_id as y from d union select r.x, l.y from reach r join l on l.x = r.y),
c as (select x, min(y) as component_id from reach group by x),
k as (select doc_id, list(g order by g) as shingles from s group by doc_id),
m as (select shingles, min(doc_id) as class_id from k group by shingles)
select d.doc_id, coalesce(n.n_shingles, 0) as n_shingles, coalesce(m.class_id, d.doc_id) as class_id, c.component_id, d.doc_id = c.component_id as kept
from d join c on c.x = d.doc_id left join n on n.doc_id = d.doc_id left join k on k.doc_id = d.doc_id left join m on m.shingles = k.shingles
"""
