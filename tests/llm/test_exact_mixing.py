"""Grace hashing and mixing against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from gridcube.llm import exact, mixing

from .conftest import awkward


def groups(rows):
    out = defaultdict(list)
    for doc_id, text, *_ in rows:
        out[text or ""].append(doc_id)
    return out


@pytest.mark.parametrize("budget", [exact.BUDGET, 3000])
def test_exact_duplicates(docs, budget):
    by_text = groups(awkward())
    wanted = Counter()
    for doc_id, text, *_ in awkward():
        ids = by_text[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        wanted[doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()] += 1
    got = Counter(tuple(r)[:5] for r in exact.exact_duplicates(docs, budget).collect())
    assert got == wanted


def test_grace_splits_to_files_and_keeps_totals():
    texts = [f"text {k % 40}".encode() * 30 for k in range(400)] + [b"hot" * 100] * 300
    records = [(t, hashlib.sha256(t).digest(), k, 1, 1) for k, t in enumerate(texts)]
    rows = list(exact.grace(iter(records), budget=2000))
    assert {r[0]: r[3] for r in rows} == Counter(texts)
    assert {r[0]: r[2] for r in rows} == {t: k for k, t in enumerate(texts)}


def agreeing(choices, n):
    """n texts whose digests get the same three choices."""
    found = defaultdict(list)
    for k in range(100_000):
        text = f"{k} ".encode() * 200
        found[tuple(choices(hashlib.sha256(text).digest()))].append(text)
        if len(hit := found[tuple(choices(hashlib.sha256(text).digest()))]) == n:
            return hit


@pytest.mark.parametrize("choices", [
    lambda digest: [digest[at] % 16 for at in (0, 8, 16)],
    lambda digest: [exact._choice(digest, level) for level in range(3)],
])
def test_grace_splits_texts_that_agree_in_three_levels(choices):
    hot, *others = agreeing(choices, 3)
    texts = others[:1] + [hot] * 500 + others
    records = [(t, hashlib.sha256(t).digest(), k, 1, 1) for k, t in enumerate(texts)]
    rows = list(exact.grace(iter(records), budget=len(hot) + 300))
    assert {r[0]: r[3] for r in rows} == Counter(texts) and len(rows) == 3
    assert {r[0]: r[2] for r in rows} == {t: k for k, t in enumerate(texts)}


def test_grace_counts_distinct_contents(monkeypatch):
    monkeypatch.setattr(exact.tempfile, "TemporaryDirectory", lambda **_: pytest.fail("copies were spilled"))
    texts = [b"hot" * 1000] * 2000 + [b"other"]
    rows = list(exact.grace(((t, hashlib.sha256(t).digest(), k, 1, 1) for k, t in enumerate(texts)), budget=10_000))
    assert {r[0]: r[3] for r in rows} == Counter(texts)


def test_grace_tells_a_digest_collision():
    same = b"x" * 32
    with pytest.raises(ValueError, match="digest"):
        list(exact.grace(iter([(b"a", same, 1, 1, 1), (b"b", same, 2, 1, 1)])))


def test_table_grows():
    table = exact.OpenTable(1)
    for k in range(200):
        table.put(k * 16, str(k).encode(), str(k).encode(), k, 1, 1)
        table.put(k * 16, str(k).encode(), str(k).encode(), k, 1, 1)
    assert sorted(r[3] for r in table.rows()) == [2] * 200


def test_without_copies_keeps_one_row_per_text(docs, make):
    rows = exact.without_copies(docs)
    assert rows.columns == docs.columns
    got = [(r["doc_id"], r["text"] or "") for r in rows.collect()]
    wanted = {text: max((i for i in ids if i is not None), default=None) for text, ids in groups(awkward()).items()}
    assert Counter(got) == Counter((i, t) for t, i in wanted.items())
    assert {tuple(r) for r in rows.collect()} <= {tuple(r) for r in docs.collect()}
    assert exact.without_copies(make([])).count() == 0 and exact.exact_duplicates(make([])).count() == 0


def reference_mix(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in rows]
    total = defaultdict(int)
    for (_, _, _, source), n in zip(rows, size):
        total[source] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in capped)
        free = [s for s in order if s not in capped]
        level = left / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if weight[s] * level > 3 * total[s]}
        if not more:
            return size, total, {s: 3 * total[s] if s in capped else weight[s] * level for s in order}
        capped |= more


def test_mixing(docs, make):
    size, total, target = reference_mix(awkward())
    got = mixing.mixed(docs).collect()
    wanted = Counter((r[0], n, total[r[3]]) for r, n in zip(awkward(), size))
    assert Counter((r["doc_id"], r["size"], r["source_size"]) for r in got) == wanted
    by_source = {r["source_size"]: r["target"] for r in got}
    for source, goal in target.items():
        assert by_source[total[source]] == pytest.approx(goal)
    for r in got:
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["copies"] in (int(rate), int(rate) + 1) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mixed(docs.repartition(5)).collect()))
    assert mixing.mixed(make([])).count() == 0


def test_taken_words_come_near_the_target(make):
    rows = [(k, "w " * (5 + k % 40), None, "a" if k % 3 else "b") for k in range(9000)]
    got = mixing.mixed(make(rows)).groupBy("source_size", "target").sum("taken").collect()
    for r in got:
        assert r["sum(taken)"] == pytest.approx(r["target"], rel=0.03)


def test_emitted_rows_are_the_copies(docs):
    out = mixing.emitted(docs)
    assert out.columns == docs.columns
    wanted = Counter()
    for r in mixing.mixed(docs).collect():
        wanted[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in out.collect()) == +wanted
