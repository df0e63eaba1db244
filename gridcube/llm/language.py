"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A document
is parsed against each automaton into the longest pieces that occur in the sample; the language
that needs the fewest pieces per character wins. No suffix link is followed while parsing: a piece
ends where the automaton has no transition, and the next one starts at its root with the same
character. That makes a parse a walk (state, letter) -> (state, piece ended), which numpy walks
for many stretches of text at once. Transitions lie in displaced rows: a state's edges start at a
place of their own in one array, among the gaps of others', so memory grows with the samples and
not with states times letters.

Whole texts are parsed, from their first letter on. A long text is walked in segments side by side,
each as if a piece began there; then the segments whose predecessor ended in another state are
walked again from that state, until they meet the walk already made, from where on both are the
same. So the pieces are those of one walk through the text, whatever its length. What Spark ships
is the sample, at most ``SAMPLE_CHARS`` per language; workers build the tables from it once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcube.llm.common import bucket_of, small_batches

SAMPLE_ROWS = 200  # labelled rows per language at most
SAMPLE_CHARS = 30_000  # characters of sample per language at most
ROW_CHARS = 3_000  # and of one row in it, so that no single document is the language
FOLDS, HELD_OUT = 4, 2
SEGMENT = 256  # letters walked in one lane
LANES = 16_384
TEMPERATURE = 40.0

_tables: dict = {}


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text: runs of anything but letters become one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    low = _is_letter(points)
    points = np.where(low, points, 32)
    keep = low.copy()
    keep[1:] |= low[:-1]
    return points[keep]


_flags: dict[int, bool] = {}
_plane = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x3000)), np.bool_)


def _is_letter(points: np.ndarray) -> np.ndarray:
    small = points < len(_plane)
    out = _plane[np.where(small, points, 0)]
    if not small.all():
        distinct, at = np.unique(points[~small], return_inverse=True)
        for c in distinct.tolist():
            if c not in _flags:
                _flags[c] = chr(c).isalpha()
        out[~small] = np.array([_flags[c] for c in distinct.tolist()], np.bool_)[at]
    return out


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring of the sequence."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


class Rows:
    """Transitions of one automaton as displaced rows: an edge (state, letter) lies at
    ``base[state] + letter``, where ``owner`` names its state."""

    def __init__(self, moves: list[dict[int, int]], width: int):
        self.alone = len(moves)  # the state after a letter that the sample lacks, a piece of its own
        size = 2 * sum(map(len, moves)) + 64
        owner = np.full(size + width, -1, np.int32)
        target = np.zeros(size + width, np.int32)
        base = np.zeros(self.alone + 1, np.int32)
        single: list[int] = []
        for state in sorted(range(len(moves)), key=lambda s: -len(moves[s])):
            own = moves[state]
            if len(own) < 2:
                if own:
                    single.append(state)
                continue
            letters = np.fromiter(own.keys(), np.int64, len(own))
            at = state * 40503 % size
            for _ in range(200):
                if (owner[at + letters] < 0).all():
                    break
                at = (at * 5 + 7919) % size
            else:  # no gap found: a row at the end
                at = len(owner)
                owner = np.concatenate([owner, np.full(width, -1, np.int32)])
                target = np.concatenate([target, np.zeros(width, np.int32)])
            base[state] = at
            owner[at + letters] = state
            target[at + letters] = np.fromiter(own.values(), np.int64, len(own))
        letters = np.array([next(iter(moves[s])) for s in single], np.int64)
        free = np.flatnonzero(owner[width:] < 0)[: len(single)] + width  # so that no base is negative
        base[single] = free - letters
        owner[free] = single
        target[free] = [next(iter(moves[s].values())) for s in single]
        # any state may ask for any letter
        self.base, self.owner, self.target = base, np.append(owner, np.full(width, -1, np.int32)), np.append(target, np.zeros(width, np.int32))
        self.restart = np.full(width, self.alone, np.int32)
        self.restart[list(moves[0].keys())] = list(moves[0].values())

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """2 * next state, plus 1 where a piece ended before the letter. Nothing comes back to
        state 0: no piece ends where a text starts."""
        at = self.base[state] + letter
        ended = self.owner[at] != state
        return np.where(ended, self.restart[letter], self.target[at]) * 2 + (ended & (state > 0))


class Parser:
    """One automaton per language over a common alphabet."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        text = {lang: letters_of(samples[lang]) for lang in self.languages}
        self.alphabet = np.unique(np.concatenate([np.array([32], np.uint32), *text.values()]))
        self.width = len(self.alphabet) + 1  # the last letter stands for all unknown ones
        self.rows = [Rows(suffix_automaton(np.searchsorted(self.alphabet, text[lang]).tolist()), self.width) for lang in self.languages]

    def pieces(self, texts: list[np.ndarray], segment: int = SEGMENT, lanes: int = LANES) -> np.ndarray:
        """Pieces per text and language."""
        out = np.zeros((len(texts), len(self.languages)))
        spans = [(k, a) for k, t in enumerate(texts) for a in range(0, len(t), segment)]
        carried = [0] * len(self.rows)  # where the last lane's text goes on with the next lot of lanes
        for first in range(0, len(spans), lanes):
            part = spans[first : first + lanes]
            owner = np.array([k for k, _ in part])
            goes_on = np.array([a > 0 for _, a in part])
            lengths = np.array([min(segment, len(texts[k]) - a) for k, a in part])
            grid = np.zeros((segment, len(part)), np.int32)
            for lane, (k, a) in enumerate(part):
                grid[: lengths[lane], lane] = texts[k][a : a + segment]
            grid = self._coded(grid)
            for n, rows in enumerate(self.rows):
                ended, last = _walked(rows, grid, lengths, goes_on, carried[n])
                np.add.at(out[:, n], owner, ended + ~goes_on)  # and the piece that the text's end cuts off
                carried[n] = last
        return out

    def _coded(self, points: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.alphabet, points)
        return np.where(self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points, at, self.width - 1).astype(np.int32)


def _walked(rows: Rows, grid: np.ndarray, lengths: np.ndarray, goes_on: np.ndarray, before: int) -> tuple[np.ndarray, int]:
    """Pieces ended per lane, and the last lane's final state. Lanes that go on start where the
    lane before them ends; ``before`` is where the one before the first ended."""
    made = np.zeros(grid.shape, np.int32)  # what each step gave
    order = np.argsort(-lengths, kind="stable")
    falling = lengths[order]
    state = np.zeros(len(lengths), np.int32)
    if goes_on[0]:
        state[0] = before
    started = state.copy()
    walk = state[order]
    for step in range(int(falling[0])):
        live = int(np.searchsorted(-falling, -step, "left"))
        lane = order[:live]
        entry = rows.step(walk[:live], grid[step, lane])
        made[step, lane] = entry
        walk[:live] = entry >> 1
    lanes = np.arange(len(lengths))
    while True:
        final = made[lengths - 1, lanes] >> 1
        wanted = np.where(goes_on, np.concatenate([[before], final[:-1]]), 0)
        again = np.flatnonzero(wanted != started)
        if not len(again):
            break
        started[again] = wanted[again]
        walk = wanted[again].astype(np.int32)
        step = 0
        while len(again):
            entry = rows.step(walk, grid[step, again])
            met = (entry >> 1) == (made[step, again] >> 1)
            made[step, again] = entry
            step += 1
            on = ~met & (lengths[again] > step)
            again, walk = again[on], entry[on] >> 1
    return (made & 1).sum(axis=0), int(final[-1])


def parser(samples: dict[str, str]) -> Parser:
    """One per worker process and sample."""
    key = hash(tuple(sorted(samples.items())))
    if key not in _tables:
        _tables.clear()
        _tables[key] = Parser(samples)
    return _tables[key]


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, row_chars: int = ROW_CHARS) -> dict[str, str]:
    """Labelled text per language, from the rows that come first by a hash of doc_id.

    Learns from no row whose crc32(doc_id) modulo FOLDS is HELD_OUT. A row gives an evenly chosen
    stretch of at most ``row_chars``.
    """
    learn = docs.select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null").where(
        bucket_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit("lang")), "doc_id")
    stretch = F.substring("text", F.lit(1) + F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - row_chars + 1)).cast("int"), F.lit(row_chars))
    picked = learn.select("lang", "doc_id", stretch.alias("text")).withColumn("n", F.row_number().over(first)).where(F.col("n") <= rows)
    out: dict[str, str] = {}
    for r in picked.orderBy("lang", "n").collect():  # at most rows * row_chars characters a language
        held = out.setdefault(r["lang"], "")
        if len(held) < chars:
            out[r["lang"]] = (held + " " + r["text"])[:chars]
    return {lang: text for lang, text in out.items() if any(c.isalpha() for c in text)}


def languages(docs: DataFrame, samples: dict[str, str] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of documents, from its whole text.

    lang_pred is ``und`` with score 0 where the text is null or has no letter, or nothing could be
    learned. score compares the winner's pieces per letter with the others'. Ties go to the
    language that sorts first. held_out is null where doc_id is. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    learned = sample(docs) if samples is None else samples

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            best, scores = ["und"] * len(texts), [0.0] * len(texts)
            if learned:
                parse = parser(learned)
                for at in range(0, len(texts), 1024):
                    codes = [letters_of(t or "") for t in texts[at : at + 1024]]
                    rate = parse.pieces(codes) / np.maximum(1, [len(c) for c in codes])[:, None]
                    low = rate.min(axis=1, keepdims=True)
                    share = np.exp(-TEMPERATURE * (rate - low))
                    for k, c in enumerate(codes):
                        if (c != 32).any():
                            win = int(rate[k].argmin())
                            best[at + k], scores[at + k] = parse.languages[win], float(share[k, win] / share[k].sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", (bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
