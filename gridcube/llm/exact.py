"""Exact deduplication by Grace hashing.

Rows are partitioned by content twice. Each input partition first reduces its own copies, so
that a text with millions of copies leaves one row per partition; the survivors are shuffled by
digest and reduced again. Both times the same Grace step runs: records go through an
open-addressing table that compares complete contents and folds copies; contents that exceed it
are dealt by a hash to spill files, and each file goes the same way with another hash. Spill files
lie in the task's own temporary folder and are gone when the task ends; a task that is run again
starts from its input.

Which rows belong to which text is told by a join on the SHA-256 of the content, in which Spark
may split a text with many copies. Two different contents of one digest would make that join
ambiguous; the table compares contents, would see it, and raises.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.llm.common import slices, small_batches

BUDGET = 32 << 20  # bytes of content that one table may hold
FANOUT = 16
RECORDS = "text binary, digest binary, keep_id long, group_size long, ties long"


class OpenTable:
    """Linear probing over a power of two of slots; a slot holds hash, content and running totals."""

    def __init__(self, expected: int):
        self.mask = (1 << max(4, (2 * expected - 1).bit_length())) - 1
        self.slots: list = [None] * (self.mask + 1)
        self.used = 0

    def put(self, key: int, text: bytes, digest: bytes, top, size: int, ties: int) -> bool:
        """Whether the content is new to the table."""
        if 2 * self.used > self.mask:
            self._grow()
        slots, mask = self.slots, self.mask
        at = key & mask
        while (held := slots[at]) is not None:
            if held[0] == key and held[2] == digest:
                if held[1] != text:
                    raise ValueError("two different texts share a SHA-256 digest")
                held[4] += size
                if top is not None and (held[3] is None or top > held[3]):
                    held[3], held[5] = top, ties
                elif top == held[3]:
                    held[5] += ties
                return False
            at = (at + 1) & mask
        slots[at] = [key, text, digest, top, size, ties]
        self.used += 1
        return True

    def _grow(self) -> None:
        old, self.mask = self.slots, 2 * self.mask + 1
        self.slots = [None] * (self.mask + 1)
        for held in old:
            if held is not None:
                at = held[0] & self.mask
                while self.slots[at] is not None:
                    at = (at + 1) & self.mask
                self.slots[at] = held

    def rows(self) -> Iterator[tuple]:
        return (tuple(held[1:]) for held in self.slots if held is not None)


def _choice(digest: bytes, level: int) -> int:
    """The spill file of a digest: another hash of the whole digest at each level, however deep."""
    return hashlib.blake2b(digest, digest_size=1, salt=level.to_bytes(16, "little")).digest()[0] % FANOUT


def grace(records: Iterator[tuple], budget: int = BUDGET, level: int = 0) -> Iterator[tuple]:
    """One record per distinct content out of (text, digest, top, size, ties) records.

    Records are folded in a table as they are read, so that the budget counts distinct contents
    and copies cost nothing. When the contents exceed it, the table is dealt to FANOUT spill files
    and filled anew. A file whose digests are all equal is one text, which no hash can split; it is
    reduced as it is read, holding one content.
    """
    table, size = OpenTable(1), 0
    for record in records:
        if table.put(int.from_bytes(record[1][:8], "little"), *record):
            size += len(record[0]) + 200
            if size > budget:
                break
    else:
        yield from table.rows()
        return

    folder = tempfile.TemporaryDirectory(prefix="grace-")
    with folder:
        files = [open(os.path.join(folder.name, str(k)), "wb") for k in range(FANOUT)]
        first: list = [None] * FANOUT
        alike = [True] * FANOUT

        def deal(full: OpenTable) -> None:
            for record in full.rows():
                k = _choice(record[1], level)
                alike[k] = alike[k] and first[k] in (None, record[1])
                first[k] = record[1]
                pickle.dump(record, files[k], protocol=pickle.HIGHEST_PROTOCOL)

        deal(table)
        table, size = OpenTable(1), 0
        for record in records:
            if table.put(int.from_bytes(record[1][:8], "little"), *record):
                size += len(record[0]) + 200
                if size > budget:
                    deal(table)
                    table, size = OpenTable(1), 0
        deal(table)
        del table
        for file in files:
            file.close()
        for k, file in enumerate(files):
            if first[k] is None:
                continue
            if alike[k]:
                single = OpenTable(1)
                for record in _spilled(file.name):
                    single.put(int.from_bytes(record[1][:8], "little"), *record)
                yield from single.rows()
            else:
                yield from grace(_spilled(file.name), budget, level + 1)
            os.unlink(file.name)


def _spilled(path: str) -> Iterator[tuple]:
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def _reduced(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    def records():
        for whole in batches:
            for batch in slices(whole):
                yield from zip(*(column.to_pylist() for column in batch.columns))

    out: list = []
    size = 0
    for row in grace(records(), budget):
        out.append(row)
        size += len(row[0])
        if size > 8 << 20:
            yield _batch(out)
            out, size = [], 0
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, digest, top, size, ties = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(text, pa.binary()), pa.array(digest, pa.binary()), pa.array(top, pa.int64()),
         pa.array(np.array(size, np.int64)), pa.array(np.array(ties, np.int64))],
        ["text", "digest", "keep_id", "group_size", "ties"],
    )


def classes(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(digest, keep_id, group_size, ties) per distinct text: the largest doc_id, the rows, and
    how many rows carry that doc_id."""
    rows = docs.select(
        F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.col("doc_id").cast("long").alias("keep_id"),
    ).select("text", F.unhex(F.sha2("text", 256)).alias("digest"), "keep_id", F.lit(1).cast("long").alias("group_size"),
             F.lit(1).cast("long").alias("ties"))

    def reduce_(batches):
        return _reduced(batches, budget)

    small_batches(docs.sparkSession)
    local = rows.mapInArrow(reduce_, RECORDS)
    return local.repartition("digest").mapInArrow(reduce_, RECORDS).drop("text")


def exact_duplicates(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, ties for every row of documents.

    Texts are equal when their UTF-8 bytes are; a null text is the empty one, and all empty
    texts form one group. keep_id is the largest doc_id of the group, null only if no row of it
    has one; kept marks the rows of that doc_id. A row repeated with its doc_id is the same
    document and gets the same answer each time; ties counts such rows. No rows give no rows.
    """
    rows = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    found = classes(docs, budget).select(F.lower(F.hex("digest")).alias("text_sha256"), "keep_id", "group_size", "ties")
    return rows.join(found, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "ties",
    )


def without_copies(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Whole rows of documents, one per distinct text: that of the largest doc_id, and one of
    them where it is repeated."""
    found = classes(docs, budget).select("digest", "keep_id", "ties")
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("own_id"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"))
    hit = own.join(found, "digest").where(F.col("own_id").eqNullSafe(F.col("keep_id")))
    single, tied = hit.where("ties = 1"), hit.where("ties > 1").dropDuplicates(["digest"])
    return single.union(tied).select("row.*")


ORACLE = """
with t as (select doc_id, coalesce(text, '') as body from documents),
g as (select body, max(doc_id) as keep_id, count(*) as group_size from t group by body)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.body) as text_sha256,
       (select count(*) from t u where u.doc_id = g.keep_id) as ties
from t join g on t.body = g.body
"""
