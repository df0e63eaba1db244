"""Token ids in shard files with a minimal perfect hash index.

Documents are range partitioned by doc_id, each partition is sorted and written as one shard: the
raw ids, then the keys, the starts and the index. The index is a minimal perfect hash: keys are
dealt to small buckets, and each bucket stores the displacement that puts all its keys on free
places of a table exactly as long as the keys are many. A place holds a 32-bit fingerprint of
its key and the document's ordinal, so a key is found, or known to be absent, in constant time.

A task writes under a name of its own attempt and reports it; only reported files are read, so
that an attempt that is lost or run twice leaves at most an unread file. The folder must be one
that all executors reach: it is made below the session's shared folder.

    magic 8 | ids, width bytes each | keys int64 | starts uint64 (n+1) | displacements int32
    | fingerprints uint32 | ordinals uint32 | footer: 8 x int64, magic 8
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcube.llm.common import crc, kept, slices, small_batches, tokenizer_path
from gridcube.llm.tokens import encoder, in_parts
from gridcube.session import fresh_dir

MAGIC = b"TOKSHRD1"
END_ID = 2
PER_BUCKET = 2
MANIFEST = "path string, first_key long, nulls long, n_docs long, n_ids long"
READ_ROWS = "doc_id long, local_start long, n_tokens long, ids_crc32 long"


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(keys: np.ndarray, displacement, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        salted = keys ^ (np.asarray(displacement, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (_mix(salted) % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of distinct int64 keys: place(key) is a bijection onto 0..n-1."""

    def __init__(self, n: int, displacements: np.ndarray):
        self.n, self.displacements = n, displacements

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        n = len(keys)
        words = keys.astype(np.int64).view(np.uint64)
        m = max(1, -(-n // PER_BUCKET))
        bucket = (_mix(words) % np.uint64(m)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=m)
        ends = np.cumsum(sizes)
        free = np.ones(n, bool)
        displacements = np.zeros(m, np.int32)
        tries = np.arange(128, dtype=np.uint64)
        largest_first = np.argsort(-sizes, kind="stable")
        for b in largest_first[sizes[largest_first] > 1]:
            own = words[order[ends[b] - sizes[b] : ends[b]]]
            at = 0
            while True:
                spots = np.sort(_places(own[None, :], (tries + np.uint64(at))[:, None], n), axis=1)
                good = free[spots].all(axis=1) & (spots[:, 1:] != spots[:, :-1]).all(axis=1)
                hit = int(good.argmax())
                if good[hit]:
                    displacements[b] = at + hit
                    free[spots[hit]] = False
                    break
                at += len(tries)
        singles = largest_first[sizes[largest_first] == 1]
        displacements[singles] = -1 - np.flatnonzero(free)[: len(singles)]  # the place itself
        return cls(n, displacements)

    def place(self, keys: np.ndarray) -> np.ndarray:
        words = np.asarray(keys, np.int64).view(np.uint64)
        d = self.displacements[(_mix(words) % np.uint64(len(self.displacements))).astype(np.int64)]
        return np.where(d < 0, -1 - d.astype(np.int64), _places(words, np.maximum(d, 0), self.n))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(np.asarray(keys, np.int64).view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def file_system(path: str):
    """The Arrow file system and the path in it; Hadoop writes local URIs with one slash."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    return pafs.FileSystem.from_uri(path)


class ShardWriter:
    def __init__(self, path: str, dtype: np.dtype):
        self.dtype = dtype
        files, inner = file_system(path)
        self.out = files.open_output_stream(inner)
        self.out.write(MAGIC)
        self.keys: list[int] = []
        self.nulls = 0
        self.lengths: list[int] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        """Keys must ascend, null ones first; equal keys are neighbours."""
        self.nulls += key is None
        self.keys.append(0 if key is None else key)
        self.lengths.append(len(ids))
        self.out.write(np.ascontiguousarray(ids, self.dtype).tobytes())

    def close(self) -> None:
        keys = np.array(self.keys, np.int64)
        starts = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.uint64)]).astype("<u8")
        distinct, ordinal = np.unique(keys[self.nulls :], return_index=True)
        index = PerfectHash.build(distinct)
        place = index.place(distinct)
        prints, ordinals = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
        prints[place], ordinals[place] = fingerprint(distinct), ordinal + self.nulls
        for part in (keys.astype("<i8"), starts, index.displacements.astype("<i4"), prints, ordinals):
            self.out.write(part.tobytes())
        footer = [self.dtype.itemsize, len(keys), self.nulls, len(distinct), len(index.displacements), int(starts[-1]), 0, 0]
        self.out.write(np.array(footer, "<i8").tobytes() + MAGIC)
        self.out.close()


class ShardReader:
    """Keyed and sequential reads of one shard."""

    def __init__(self, path: str):
        files, inner = file_system(path)
        self.file = files.open_input_file(inner)
        size = self.file.size()
        tail = self.file.read_at(72, size - 72) if size >= 80 else b""
        if tail[64:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is not a whole token shard")
        width, n, self.nulls, distinct, m, ids, _, _ = np.frombuffer(tail, "<i8", 8).tolist()
        self.dtype, self.n = np.dtype(f"<u{width}"), n
        at = 8 + ids * width

        def section(kind: str, count: int) -> np.ndarray:
            nonlocal at
            data = np.frombuffer(self.file.read_at(count * np.dtype(kind).itemsize, at), kind)
            at += data.nbytes
            return data

        self.keys, self.starts = section("<i8", n), section("<u8", n + 1).astype(np.int64)
        self.index = PerfectHash(distinct, section("<i4", m))
        self.prints, self.ordinals = section("<u4", distinct), section("<u4", distinct)

    def ordinal(self, keys: np.ndarray) -> np.ndarray:
        """Ordinal of the first document of each key, -1 where the shard has none."""
        keys = np.asarray(keys, np.int64)
        if not self.index.n:
            return np.full(len(keys), -1)
        place = self.index.place(keys)
        first = self.ordinals[place].astype(np.int64)
        return np.where((self.prints[place] == fingerprint(keys)) & (self.keys[first] == keys), first, -1)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of documents first..last-1, one read."""
        width = self.dtype.itemsize
        a, b = self.starts[first], self.starts[last]
        return np.frombuffer(self.file.read_at(int(b - a) * width, 8 + int(a) * width), self.dtype)

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of every document of a key."""
        at, found = int(self.ordinal(np.array([key]))[0]), []
        while 0 <= at < self.n and self.keys[at] == key:
            found.append(self.ids(at, at + 1))
            at += 1
        return found

    def documents(self, at_once: int = 4 << 20) -> Iterator[tuple]:
        """(key, local start, ids) in file order, every key looked up in the index."""
        first = 0
        looked = self.ordinal(self.keys)
        while first < self.n:
            last = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + at_once, "right")) - 1)
            block = self.ids(first, last)
            for k in range(first, last):
                key = None if k < self.nulls else int(self.keys[k])
                if key is not None and (looked[k] < 0 or self.keys[looked[k]] != key):
                    raise ValueError(f"the index misses key {key}")
                a, b = self.starts[k] - self.starts[first], self.starts[k + 1] - self.starts[first]
                yield key, int(self.starts[k]), block[a:b]
            first = last


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write every document's ids and end_id below ``folder``; returns the manifest, one row per shard."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, out, path, first = encoder(tokenizer), None, f"{folder}/{uuid.uuid4().hex}.tok", None
        for batch in (part for whole in batches for part in slices(whole)):
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, part in in_parts(texts):
                for key, ids in zip(keys[at : at + len(part)], code.encode(part)):
                    if out is None:
                        out = ShardWriter(path, code.dtype)
                    first = key if first is None else first
                    out.add(key, np.append(ids, np.array(end_id, code.dtype)))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"path": path, "first_key": first, "nulls": out.nulls, "n_docs": len(out.keys), "n_ids": sum(out.lengths)}],
                pa.schema([("path", pa.string()), *((n, pa.int64()) for n in ("first_key", "nulls", "n_docs", "n_ids"))]),
            )

    small_batches(docs.sparkSession)
    files, inner = file_system(folder)
    files.create_dir(inner, recursive=True)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return kept(ordered.mapInArrow(write, MANIFEST))


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files of the manifest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                for key, start, ids in ShardReader(path).documents():
                    rows.append((key, base + start, len(ids), crc(ids.astype("<u4").tobytes())))
                    if len(rows) == 20_000:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    before = Window.orderBy(F.col("nulls").desc(), F.col("first_key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("base"))
    shards = max(1, manifest.count())
    return placed.repartition(shards, "path").mapInArrow(read, READ_ROWS).select(
        "doc_id", F.col("local_start").alias("start"), "n_tokens", "ids_crc32")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.int64()) for column in zip(*rows)], ["doc_id", "local_start", "n_tokens", "ids_crc32"])


def token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write all documents as shards, then read the shards back.

    Returns doc_id, start (ids of all documents before it, in ascending doc_id order), n_tokens
    with the end id, and the crc32 of the ids as little-endian 32-bit integers. A null or empty
    text is the end id alone. Null doc_ids come first and are outside the index; rows of one
    doc_id lie side by side, ordered by text. No documents give no shards and no rows.
    """
    folder = fresh_dir(docs.sparkSession, "token-shards")
    return read_shards(write_shards(docs, folder, tokenizer or tokenizer_path(), end_id))
