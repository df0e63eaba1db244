"""Token ids, shards and packing against the tokenizer itself."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridcube.llm import packing, token_files
from gridcube.llm.common import tokenizer_path
from gridcube.llm.tokens import encoder

from .conftest import awkward

CODE = encoder(tokenizer_path())


def ids_of(text, end):
    return [*CODE.tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"abZ'.,!<|>09éÉüßİıſςΣΩ\u0301\u0085\x1c \n\t日k_-@&", "<|endoftext|>", "don't", "'s"])).map("".join))
def test_chunkwise_ids_are_the_tokenizers(text):
    assert CODE.encode([text])[0].tolist() == CODE.tokenizer.encode(text, add_special_tokens=False).ids


def test_perfect_hash_is_a_bijection():
    for n in (0, 1, 2, 3, 50, 5000):
        keys = np.unique(np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n))
        index = token_files.PerfectHash.build(keys)
        assert sorted(index.place(keys).tolist() if len(keys) else []) == list(range(len(keys)))


def test_shard_round_trip(tmp_path):
    path = str(tmp_path / "one.tok")
    out = token_files.ShardWriter(path, np.dtype("<u2"))
    rows = [(None, [9]), (-5, [1, 2]), (3, []), (7, [4, 5, 6]), (7, [8])]
    for key, ids in rows:
        out.add(key, np.array(ids, np.uint16))
    out.close()
    shard = token_files.ShardReader(path)
    assert [(k, ids.tolist()) for k, _, ids in shard.documents(at_once=2)] == rows
    assert [x.tolist() for x in shard.get(7)] == [[4, 5, 6], [8]] and shard.get(8) == [] and shard.get(0) == []
    path2 = tmp_path / "cut.tok"
    path2.write_bytes((tmp_path / "one.tok").read_bytes()[:-3])
    with pytest.raises(ValueError, match="whole"):
        token_files.ShardReader(str(path2))


def test_token_files(docs, make):
    rows = sorted(awkward(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    wanted, start = [], 0
    for doc_id, text, *_ in rows:
        ids = ids_of(text, 2)
        wanted.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = sorted(map(tuple, token_files.token_files(docs).collect()), key=lambda r: r[1])
    assert got == wanted
    assert token_files.token_files(make([])).count() == 0


def packed_ok(rows, length):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(held)


@pytest.mark.parametrize("length", [4096, 64])
def test_packing(docs, make, length):
    got = packing.packed(docs, length=length, with_ids=True).collect()
    wanted = Counter()
    for doc_id, text, *_ in awkward():
        ids = ids_of(text, 1)
        for piece, at in enumerate(range(0, len(ids), length)):
            own = ids[at : at + length]
            wanted[doc_id, piece, at, len(own), crc(own), tuple(own)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in got) == wanted
    used = packed_ok(got, length)
    assert used <= 1.02 * sum(r["length"] for r in got) / length + 1
    assert packing.packed(make([])).count() == 0


def first_fit_decreasing(counts, length):
    spaces = []
    for size in sorted(Counter(counts).elements(), reverse=True):
        for k, space in enumerate(spaces):
            if space >= size:
                spaces[k] -= size
                break
        else:
            spaces.append(length - size)
    return len(spaces)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_and_packs_tightly(seed):
    draw = random.Random(seed)
    length = draw.choice([50, 300, 4096])
    counts = Counter(min(length, max(1, int(draw.lognormvariate(0, 1) * length / draw.choice([3, 6])))) for _ in range(1500))
    plan = packing.Plan(counts, length)
    placed = Counter()
    for content, n, space in zip(plan.content, plan.count, plan.space):
        used = 0
        while content:
            size, times, content = content
            placed[size] += n * times
            used += size * times
        assert used + space == length
    assert placed == counts
    assert plan.sequences <= 1.01 * first_fit_decreasing(counts, length) + 1


def test_nnls_finds_the_least_squares():
    rng = np.random.default_rng(1)
    A, true = rng.random((20, 30)), np.where(rng.random(30) < 0.3, rng.random(30) * 5, 0)
    x = packing.nnls(A, A @ true)
    assert (x >= 0).all() and np.abs(A @ x - A @ true).max() < 1e-6
