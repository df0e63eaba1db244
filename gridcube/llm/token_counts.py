"""Token counts of whole texts by byte-pair merging, without making a token.

A text is cut where the vocabulary's own rules cut it, and each piece starts as its bytes in a doubly linked
list. A heap holds the adjacent pairs that the vocabulary merges, lowest rank first and leftmost among
equals; the pair popped becomes one symbol and the pairs with its new neighbours join the heap. The
count is the bytes less the merges: symbols are only numbers of strings, no identifier leaves the merging.
A piece of n bytes costs n log n whatever it holds, so one endless word is no worse than many short ones.

Pieces never reach from a character into the white space behind it, so a text falls apart into chunks, white space
and what follows it, that do not touch each other. A worker remembers the counts of the short chunks it met
lately, a bounded number, and merges only what is new to it.
"""

from __future__ import annotations

import heapq
import json
import os

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcube.llm.common import Remembered, slices, small_batches, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
REMEMBERED = 400_000  # chunks in each of the two generations a worker remembers
SHORT = 48  # characters of a chunk worth remembering
# How byte-level vocabularies cut a text, and what they take for white space.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SETTLED = "\u024f"  # up to here every table of Unicode agrees what is a letter

_counters: dict = {}


def byte_letters() -> dict[str, int]:
    """The byte behind each printable character that byte-level vocabularies write for it."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Ranks of the pairs that merge. Symbols are numbers of byte strings, the first 256 the bytes."""

    def __init__(self, pairs: list):
        byte_of = byte_letters()
        number = {bytes([b]): b for b in range(256)}
        self.rank, self.made = {}, []
        for rank, pair in enumerate(pairs):
            left, right = (bytes(byte_of[c] for c in side) for side in (pair.split(" ") if isinstance(pair, str) else pair))
            made = number.setdefault(left + right, len(number))
            self.rank.setdefault(number[left] << 32 | number[right], rank)
            self.made.append(made)

    def count(self, piece: bytes) -> int:
        """Symbols that are left of a piece when nothing merges any more."""
        left = n = len(piece)
        rank_of, made = self.rank.get, self.made
        symbol, after, before = list(piece), list(range(1, n + 1)), list(range(-1, n - 1))
        # an entry is the rank and the place of its left symbol in one number: lowest rank first, then leftmost
        heap = []
        for at, pair in enumerate(zip(piece, piece[1:])):
            rank = rank_of(pair[0] << 32 | pair[1])
            if rank is not None:
                heap.append(rank << 32 | at)
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            rank, at = entry >> 32, entry & 0xFFFFFFFF
            right = after[at]
            # a pair is stale once either of its symbols took part in another merge
            if symbol[at] < 0 or right == n or rank_of(symbol[at] << 32 | symbol[right]) != rank:
                continue
            new = made[rank]
            symbol[at], symbol[right] = new, -1
            after[at] = following = after[right]
            left -= 1
            if following < n:
                before[following] = at
                found = rank_of(new << 32 | symbol[following])
                if found is not None:
                    heapq.heappush(heap, found << 32 | at)
            ahead = before[at]
            if ahead >= 0:
                found = rank_of(symbol[ahead] << 32 | new)
                if found is not None:
                    heapq.heappush(heap, found << 32 | ahead)
        return left


class Counter:
    """Tokens of a text as the vocabulary file's library counts them, special strings included."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        cuts = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        special = spec.get("added_tokens") or []
        bare = not any(t.get(k) for t in special for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if not (plain and cuts and bare) or spec.get("normalizer") or set(byte_letters()) - set(model["vocab"]):
            raise ValueError(f"{path} is not a plain byte-level byte-pair vocabulary")
        self.merges = Merges(model["merges"])
        longest_first = sorted((t["content"] for t in special if t["content"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.pieces, self.chunks = regex.compile(PIECES), regex.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
        self.beyond = regex.compile(f"[^\0-{SETTLED}]")
        self.disputed = Remembered(self._disputed, REMEMBERED)
        self.of_chunk = Remembered(self._chunk, REMEMBERED)

    def _disputed(self, letter: str) -> bool:
        """Whether the library's table of Unicode puts the character in another class than ours: tables
        differ in age. Cut by the library, it joins a letter, a digit or a sign and nothing else."""
        ours = [len(self.pieces.findall(mate + letter)) for mate in "a0!"]
        return ours != [len(self.cut(mate + letter)) for mate in "a0!"]

    def _chunk(self, chunk: str) -> int:
        if self.beyond.search(chunk) and any(map(self.disputed.__getitem__, set(self.beyond.findall(chunk)))):
            pieces = [chunk[a:b] for _, (a, b) in self.cut(chunk)]
        else:
            pieces = self.pieces.findall(chunk)
        count = self.merges.count
        return sum([count(piece.encode()) for piece in pieces])

    def count(self, text: str | None) -> int:
        """Tokens of the text; a null text is an empty one."""
        if not text:
            return 0
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        known, new = self.of_chunk, self._chunk
        return sum([known[chunk] if len(chunk) <= SHORT else new(chunk) for chunk in self.chunks(text)])


def counter(path: str) -> Counter:
    """One per worker process and vocabulary."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row with doc_id and text.

    n_bytes is the length in UTF-8, n_tokens what the library gives for the vocabulary file (a byte-level byte-pair
    file of the tokenizers library; another raises ValueError) without added tokens, over_limit whether that is
    more than ``limit``. A null or empty text has 0 of both. Rows are neither joined nor merged: a repeated row, or one
    without doc_id, comes back as often as it is there. Other columns are ignored; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    path = vocabulary or tokenizer_path(VOCABULARY)
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    out = T.StructType([rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def counted(batches):
        tokens = counter(path)
        for batch in batches:
            for part in slices(batch):
                counts = [tokens.count(text) for text in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["n_bytes"], pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(counted, out).withColumn("over_limit", F.col("n_tokens") > limit)
