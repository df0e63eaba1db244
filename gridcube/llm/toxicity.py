"""Toxicity by a learned lexicon, matched through Levenshtein automata, scored in context.

Fitting, on a bounded sample of labelled rows: words and word stems whose document counts speak
strongly for the toxic label become the lexicon, a trie. The automaton that accepts every word
within a term's allowed distance of it is intersected with the trie; its states are sets of
(trie node, errors), made deterministic as they are met and kept per worker, so that most words
leave it after a few characters. Every term has its misspellings; only words close to it that
clean documents use at least as often as toxic ones are exceptions, and others that clean
documents use weigh what their own counts say. How often a term's misspelled hits, and those of
terms that begin like it, turn up in clean documents whose words were not looked at is a share of
their weight that counts as a feature of its own, so that a misspelled hit weighs by the term it
stands for. Hits count differently by distance and by context: a window around each hit tells
whether it stands in quotation marks or beside a word of reporting, and how dense hits are.

A ridge logistic regression, with prior means that say what the features mean, weighs them. No
kind of hit may speak against the label, and none misspelled may speak louder than the exact one.
Rows with exact hits teach four times, with a quarter of their weight: as they are and with all hits but
the strongest left out, each also with its terms misspelled. Labelled rows seldom show a term alone
or all of them misspelled, and weights that nothing holds up would go to what such rows happen to share.

Scoring is one pass over the documents, without a shuffle; the model is a few hundred terms.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.llm.common import Remembered, bucket_of, kept, slices, small_batches
from gridcube.llm.minhash import band_hashes, shingles, signature

FIT_ROWS = 6000  # labelled rows of each class at most that a model is fitted on
STEMS = (4, 5, 6)  # lengths of word beginnings that may become terms
FAMILY = 4  # terms that begin with the same letters share the doubt about their misspellings
WINDOW = 8  # words on either side of a hit
KNOWN = 100_000  # words in each of the two generations whose verdict a worker remembers
COUNTS = ("toxic", "clean", "toxic_0", "clean_0")
HELD_OUT = 5  # rows whose crc32(doc_id) is divisible by it are never learned from

EDGE = re.compile(r"^[^\w@$]+|[^\w]+$")
FOLD = str.maketrans("013457@$", "oieastas")
QUOTES = "\"'“”„‘’«»"
REPORTING = frozenset("said says called calls wrote quote quoted quotes unquote".split())
# intercept, plain exact, quoted exact, plain fuzzy, quoted fuzzy, the same two as far as clean
# words crowd around the terms, densest window, share of words
PRIOR = np.array([-3.0, 5.0, 1.5, 3.5, 0.5, 1.0, 0.2, 1.0, 1.0])
EXACT_AND_WRONG = ((1, 3), (2, 4))  # places of exact hits and of misspelled ones in the same context
RIDGE = 0.5
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def cleaned(token: str) -> str:
    """A lower-cased token without the punctuation around it; digits that stand for letters folded."""
    word = EDGE.sub("", token)
    return word if word.isalpha() else word.translate(FOLD)


def distance_of(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """The intersection of a trie of terms with the Levenshtein automata of their distances.

    ``terms``: weights of words; one that ends in * is a stem, which any word that begins with it
    matches. Words in ``exceptions`` match nothing. ``crowds``: which share of a term's misspelled
    hits is doubtful, 0 where it is not named. ``own``: weights of misspellings that are known.
    """

    def __init__(self, terms: dict[str, float], exceptions=(), crowds: dict[str, float] | None = None, own: dict[str, float] | None = None):
        self.exceptions, self.crowds, self.own = frozenset(exceptions), crowds or {}, own or {}
        self.term: list[str] = [""]
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]  # distance allowed to the term that ends here
        self.weight: list[float] = [0.0]
        self.stem: list[float] = [0.0]  # weight of the stem that ends here
        self.room: list[int] = [0]  # most errors that any term below allows
        for term, weight in terms.items():
            self._add(term, weight, 0 if term.endswith("*") else distance_of(term))
        self.known = Remembered(lambda token: self.hit(cleaned(token)), KNOWN)
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.verdicts: list[tuple | None] = []
        self.start = self._state(self._closed({(0, 0)}), 0.0)

    def _add(self, term: str, weight: float, allowed: int) -> None:
        stem = term.endswith("*")
        word = term.rstrip("*")
        node = 0
        self.room[0] = max(self.room[0], allowed)
        for c in word:
            if c not in self.child[node]:
                self.child[node][c] = len(self.child)
                self.child.append({})
                self.ends.append(-1)
                self.term.append("")
                self.weight.append(0.0)
                self.stem.append(0.0)
                self.room.append(0)
            node = self.child[node][c]
            self.room[node] = max(self.room[node], allowed)
        if stem:
            self.stem[node] = weight
        else:
            self.ends[node], self.weight[node], self.term[node] = allowed, weight, term

    def _closed(self, places: set) -> frozenset:
        """With the places reached by leaving out characters of a term."""
        todo, seen = list(places), set(places)
        while todo:
            node, errors = todo.pop()
            for below in self.child[node].values():
                if errors + 1 <= self.room[below] and (below, errors + 1) not in seen:
                    seen.add((below, errors + 1))
                    todo.append((below, errors + 1))
        least: dict[int, int] = {}
        for node, errors in seen:
            least[node] = min(errors, least.get(node, errors))
        return frozenset(least.items())

    def _state(self, places: frozenset, stem: float) -> int:
        """``stem``: the largest weight of a stem that the word has passed."""
        stem = max([stem, *(self.stem[node] for node, errors in places if errors == 0)])
        key = (places, stem)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            reached = [(errors > 0, self.weight[node], self.term[node]) for node, errors in places if errors <= self.ends[node]]
            if stem:
                reached.append((False, stem, ""))
            self.verdicts.append(min(reached, key=lambda r: (r[0], -r[1]), default=None))
        return self.numbers[key]

    def _move(self, state: int, c: str) -> int:
        places, stem = self.states[state]
        after = set()
        for node, errors in places:
            for letter, below in self.child[node].items():
                cost = errors + (letter != c)
                if cost <= self.room[below]:
                    after.add((below, cost))
            if errors + 1 <= self.room[node]:
                after.add((node, errors + 1))
        target = self._state(self._closed(after), stem)
        self.moves[state][c] = target
        return target

    def match(self, word: str) -> tuple[bool, float, str] | None:
        """(misspelled, weight, term) of the term or stem that the word stands for, if any."""
        if word in self.exceptions:
            return None
        if len(self.states) > 50_000:
            self._reset()
        state = self.start
        for c in word:
            following = self.moves[state].get(c)
            if following is None:
                following = self._move(state, c)
            state = following
            if not self.states[state][0]:
                break
        return self.verdicts[state]

    def hit(self, word: str) -> tuple[bool, float, float, float] | None:
        """(misspelled, weight, doubtful share of it, how far the hit counts as one) of a match."""
        found = self.match(word)
        if not found or not found[0]:
            return found and (False, found[1], 0.0, 1.0)
        if word in self.own:
            weight = min(found[1], self.own[word])
            return True, weight, 0.0, weight / found[1]
        doubt = self.crowds.get(found[2], 0.0)
        return True, found[1], doubt, 1 - doubt

    def features(self, text: str | None) -> list[float]:
        tokens = (text or "").lower().split()
        known = self.known
        verdicts = list(map(known.__getitem__, tokens))
        hits = [i for i, verdict in enumerate(verdicts) if verdict]
        sums = [0.0] * 6
        firm: list[float] = []
        densest = inside = 0.0
        first = 0
        for i in hits:
            misspelled, weight, doubt, counts = verdicts[i]
            reported = _reported(tokens, i)
            sums[2 * misspelled + reported] += weight * (1 - doubt)
            sums[4 + reported] += weight * doubt
            firm.append(counts)
            inside += counts
            while hits[first] < i - 2 * WINDOW:
                inside -= firm[first]
                first += 1
            densest = max(densest, inside)
        return [1.0, *(math.log1p((x / 5) ** 2) for x in sums), math.log1p(max(0.0, densest - 1)), math.sqrt(sum(firm) / max(1, len(tokens)))]


def _reported(tokens: list[str], i: int) -> bool:
    """Whether the word stands between quotation marks or beside a word of reporting."""
    before, after = tokens[max(0, i - WINDOW) : i + 1], tokens[i : i + WINDOW + 1]
    opened = any(t[0] in QUOTES for t in before)
    closed = any(t.rstrip(".,;:!?")[-1:] in QUOTES and t.rstrip(".,;:!?") for t in after)
    return (opened and closed) or any(t.strip(".,;:!?" + QUOTES) in REPORTING for t in before[-4:])


def labelled(docs: DataFrame, labels: DataFrame, column: str, rows: int = FIT_ROWS, folds: int = HELD_OUT) -> DataFrame:
    """(text, label): of each class the ``rows`` labelled documents that come first by a hash of
    doc_id. Rows without a label and held out ones are left; a label given twice counts as its
    larger value."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(column).cast("int").alias("label")).where(
        "_id is not null and label in (0, 1)").where(bucket_of(F.col("_id"), folds) != 0).groupBy("_id").agg(F.max("label").alias("label"))
    known = kept(known)
    draw = F.xxhash64("_id", F.lit("fit"))
    some = known.where("label = 1").orderBy(draw, "_id").limit(rows).union(known.where("label = 0").orderBy(draw, "_id").limit(rows))
    return docs.select(F.col("doc_id").alias("_id"), "text").join(some, "_id").select("_id", F.coalesce("text", F.lit("")).alias("text"), "label")


def unlike(sample: DataFrame) -> DataFrame:
    """One row of each group of near copies of one label among the sampled rows: words of a text
    that was copied a hundred times would otherwise look as telling as words of a hundred texts.

    A row goes if a row of its label with a smaller id shares one of 16 bands of 5 of its MinHashes
    over two-word shingles and agrees with it in at least 0.8 of all 80.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            hashes = [signature(own, 80) if len(own := shingles(text, 2)) else None for text in batch.column(1).to_pylist()]
            bands = [None if own is None else band_hashes(own, 5) for own in hashes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(bands, pa.list_(pa.int64())),
                 pa.array([None if own is None else own.astype(np.int64) for own in hashes], pa.list_(pa.int64()))],
                ["_id", "label", "bands", "hashes"])

    signed = kept(sample.select("_id", "text", "label").mapInArrow(sign, "_id long, label int, bands array<long>, hashes array<long>"))
    seen = signed.select("_id", "label", F.explode("bands").alias("band"))
    first = seen.groupBy("label", "band").agg(F.min("_id").alias("first"))
    pairs = seen.join(first, ["label", "band"]).where("first < _id").select("_id", "first").distinct()
    pairs = pairs.join(signed.select("_id", "hashes"), "_id").join(signed.select(F.col("_id").alias("first"), F.col("hashes").alias("other")), "first")
    same = F.aggregate(F.zip_with("hashes", "other", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return sample.join(pairs.where(same >= 64).select("_id").distinct(), "_id", "left_anti")


def _vocabulary(rows: DataFrame) -> DataFrame:
    """(term, toxic, clean, toxic_0, clean_0): in how many documents of either class each word and
    stem occurs, and in how many of half 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 128)):
            counts = Counter(), Counter(), Counter(), Counter()
            for text, label, half in zip(*(column.to_pylist() for column in batch.columns)):
                words = {w for w in map(cleaned, set(text.lower().split())) if len(w) > 2}
                terms = words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}
                counts[1 - label].update(terms)
                if not half:
                    counts[3 - label].update(terms)
            terms = list({**counts[0], **counts[1]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *(pa.array([found[t] for t in terms], pa.int64()) for found in counts)], ["term", *COUNTS])

    found = rows.select("text", "label", "half").mapInArrow(count, "term string, " + ", ".join(f"{c} long" for c in COUNTS))
    return found.groupBy("term").agg(*(F.sum(c).alias(c) for c in COUNTS))


def surprise(a: float, b: float, total_a: float, total_b: float) -> float:
    """Log-likelihood ratio of a term in a of total_a against b of total_b documents."""
    def part(k, n, p):
        p = min(max(p, 1e-12), 1 - 1e-12)
        return k * math.log(p) + (n - k) * math.log(1 - p)
    p = (a + b) / (total_a + total_b)
    return 2 * (part(a, total_a, a / total_a) + part(b, total_b, b / total_b) - part(a, total_a, p) - part(b, total_b, p))


def _lexicon(counts: list, toxic: int, clean: int) -> dict[str, float]:
    """Terms that speak for the label on their own, and their log odds. A stem must speak louder
    than each of its words and stand for several of them."""
    strong, least = {}, 8 + 2 * math.log(toxic + 1)  # more rows bring more words that look telling by chance
    for term, a, b in counts:
        if a / toxic > 12 * (b + 0.5) / (clean + 1) and (score := surprise(a, b, toxic, clean)) > least:
            strong[term] = score, math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
    out = []
    seen = Counter(t[:n] for t, _, _ in counts if not t.endswith("*") for n in STEMS if len(t) > n)
    for term, (score, odds) in strong.items():
        if term.endswith("*"):
            stem = term[:-1]
            inner = [s for t, (s, _) in strong.items() if t != term and t.startswith(stem)]
            if seen[stem] < 3 or any(s >= score for s in inner):
                continue
        out.append((-score, term, odds))
    return {term: odds for _, term, odds in sorted(out)}


def misspelled(text: str, lexicon: Lexicon) -> str | None:
    """The text with one letter changed, left out or put in in each word that is a term, wherever
    the term allows it; None if no word is one. The same for the same text."""
    tokens = text.lower().split()
    draw = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    found = False
    for k, token in enumerate(tokens):
        word = cleaned(token)
        hit = lexicon.match(word) if lexicon.known[token] else None
        if hit and not hit[0] and hit[2] and distance_of(word):
            at, kind = draw.randrange(1, len(word)), draw.randrange(3)
            put = draw.choice([c for c in LETTERS if c != word[at]]) if kind < 2 else ""
            wrong = word[:at] + put + word[at + (kind != 1) :]
            tokens[k] = token.replace(word, wrong) if word in token else wrong
            found = True
    return " ".join(tokens) if found else None


def alone(text: str, lexicon: Lexicon) -> str:
    """The text without its hits but the first of those that weigh most."""
    tokens = text.lower().split()
    found = {k: hit for k, token in enumerate(tokens) if (hit := lexicon.known[token])}
    best = max(found, key=lambda k: (not found[k][0], found[k][1], -k), default=None)
    return " ".join(token for k, token in enumerate(tokens) if k == best or k not in found)


def lessons(text: str, lexicon: Lexicon) -> list[str]:
    """What a labelled row teaches: itself, and where a term occurs copies of it."""
    wrong = misspelled(text, lexicon)
    if not wrong:
        return [text]
    single = alone(text, lexicon)
    return [text, wrong, single, misspelled(single, lexicon) or single]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weighted logistic regression drawn towards ``prior`` by projected Newton steps.

    All coefficients but the first are at least 0, and each kind of misspelled hit has at most that
    of the exact hit in the same context: the exact one's is written as the largest misspelled
    one's plus a rest, and the rest bounded instead.
    """
    mix = np.eye(len(prior))
    for exact, wrong in EXACT_AND_WRONG:
        mix[exact, wrong] = 1.0  # coefficient of exact = rest + coefficient of wrong
    inner, aim = x @ mix, np.linalg.solve(mix, prior)

    def loss(b):
        z = inner @ b
        return weight @ (np.logaddexp(0, z) - y * z) + ridge / 2 * ((b - aim) ** 2).sum()

    beta = aim.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(inner @ beta, -30, 30)))
        gradient = inner.T @ (weight * (p - y)) + ridge * (beta - aim)
        hessian = (inner * (weight * p * (1 - p))[:, None]).T @ inner + ridge * np.eye(len(aim))
        free = (beta > 0) | (gradient < 0)
        free[0] = True
        step = np.zeros(len(aim))
        step[free] = np.linalg.solve(hessian[np.ix_(free, free)], -gradient[free])
        size, now = 1.0, loss(beta)
        while True:
            after = beta + size * step
            after[1:] = np.maximum(0.0, after[1:])
            if loss(after) <= now or size < 1e-9:
                break
            size /= 2
        moved, beta = np.abs(after - beta).max(), after
        if moved < 1e-7:
            break
    return mix @ beta


class Model:
    def __init__(self, terms: dict[str, float], exceptions: list[str], crowds: dict[str, float], own: dict[str, float], beta: np.ndarray):
        self.terms, self.exceptions, self.crowds, self.own, self.beta = terms, exceptions, crowds, own, beta

    def scorer(self):
        lexicon = Lexicon(self.terms, self.exceptions, self.crowds, self.own)

        def score(texts: list) -> np.ndarray:
            x = np.array([lexicon.features(t) for t in texts]).reshape(-1, len(self.beta))
            return 1 / (1 + np.exp(-np.clip(x @ self.beta, -30, 30)))

        return score


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learn lexicon, exceptions and weights. Without labels of both classes the model has no
    terms and scores everything by the prior.

    The weights are fitted to what each half of the sample shows with the exceptions of the other
    half: with its own, no word of it that is unknown would come close to a term by chance, as
    words of other documents do.
    """
    small_batches(docs.sparkSession)
    sample = unlike(kept(labelled(docs, labels, "toxic", rows)))
    sample = kept(sample.withColumn("half", bucket_of(F.xxhash64("_id", F.lit("half")), 2).cast("int")))
    sizes = {(r["label"], r["half"]): r["count"] for r in sample.groupBy("label", "half").count().collect()}
    toxic, clean = ([sizes.get((label, half), 0) for half in (0, 1)] for label in (1, 0))
    if not sum(toxic) or not sum(clean):
        return Model({}, [], {}, {}, PRIOR)
    vocabulary = kept(_vocabulary(sample))
    often = vocabulary.where((F.col("toxic") >= 2) & (F.col("toxic") / sum(toxic) > 12 * (F.col("clean") + 0.5) / (sum(clean) + 1)))
    found = {r["term"]: (r["toxic"], r["clean"]) for r in often.collect()}
    terms = _lexicon([(term, a, b) for term, (a, b) in found.items()], sum(toxic), sum(clean))
    lexicon = Lexicon(terms)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [lexicon.match(w) for w in batch.column(0).to_pylist()]
            of = pa.array([hit[2] if hit and hit[0] else None for hit in hits], pa.string())
            out = pa.RecordBatch.from_arrays([*batch.columns, of], ["word", *COUNTS, "term"])
            yield out.filter(of.is_valid())

    plain = vocabulary.where(~F.endswith("term", F.lit("*")) & (F.col("clean") > 0))  # terms match themselves exactly and stay
    near = plain.select("term", *COUNTS).mapInArrow(
        close, "word string, " + ", ".join(f"{c} long" for c in COUNTS) + ", term string").collect()  # words of the bounded sample

    def judged(half: int | None) -> tuple[list[str], dict[str, float]]:
        """Near words of clean rows, of a half or of all: those that have them at least as often
        as toxic rows, and log odds of the others."""
        t, c = (sum(n) if half is None else n[half] for n in (toxic, clean))
        usual, own = [], {}
        for r in near:
            x, y = (r[n] if half is None else r[n + "_0"] if half == 0 else r[n] - r[n + "_0"] for n in ("toxic", "clean"))
            if y and y * t >= x * c:
                usual.append(r["word"])
            elif y:
                own[r["word"]] = max(0.0, math.log((x + 0.5) / (t + 1)) - math.log((y + 0.5) / (c + 1)))
        return usual, own

    around = Counter()  # in clean rows of one half, words that the other half's would not have excepted
    for r in near:
        parts = (r["clean_0"], r["clean"] - r["clean_0"])
        around[r["term"][:FAMILY]] += sum(parts) * (min(parts) == 0) / sum(clean)
    words = [term for term in terms if not term.endswith("*")]
    relatives = Counter(term[:FAMILY] for term in words)
    crowds = {}
    for term in words:
        a, b = found[term]
        if share := around[term[:FAMILY]]:
            crowds[term] = share / (share + a / sum(toxic))
            # as a word like it, it would be met in clean documents as often as those were
            b += share * sum(clean) / relatives[term[:FAMILY]]
            terms[term] = max(0.1, math.log((a + 0.5) / (sum(toxic) + 1)) - math.log((b + 0.5) / (sum(clean) + 1)))
    exceptions, own = judged(None)
    halves = [Lexicon(terms, others, crowds, weights) for others, weights in (judged(1), judged(0))]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, weights = [], [], []
            for text, label, half in zip(*(column.to_pylist() for column in batch.columns)):
                copies = lessons(text, halves[half])
                x += [halves[half].features(t) for t in copies]
                y += [label] * len(copies)
                weights += [1 / len(copies)] * len(copies)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.int32()), pa.array(weights, pa.float64())], ["x", "label", "weight"])

    fitted = sample.select("text", "label", "half").mapInArrow(features, "x array<double>, label int, weight double").collect()  # the bounded sample
    x, y, weight = np.array([r["x"] for r in fitted]), np.array([r["label"] for r in fitted], float), np.array([r["weight"] for r in fitted])
    return Model(terms, exceptions, crowds, own, logistic(x, y, weight, PRIOR))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of documents, from its whole text.

    A null text counts as empty; empty texts get the score of a text without hits. held_out is null
    where doc_id is. Rows repeated get equal answers. No rows give no rows.
    """
    learned = model or fit(docs, labels, rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = learned.scorer()
        for batch in (part for whole in batches for part in slices(whole)):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer(batch.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id", (bucket_of(F.col("doc_id"), HELD_OUT) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """Whole rows of documents that score below 0.5; one pass, nothing joined."""
    learned = fit(docs, labels, rows)
    columns = docs.columns
    text = columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = learned.scorer()
        for batch in (part for whole in batches for part in slices(whole)):
            yield batch.filter(pa.array(scorer(batch.column(text).to_pylist()) < 0.5, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
