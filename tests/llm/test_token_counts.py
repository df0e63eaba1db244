"""Token counts against the vocabulary's own library."""

from collections import Counter
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from gridcube.llm import token_counts
from gridcube.llm.common import table, tokenizer_path

from .conftest import awkward

PATH = tokenizer_path(token_counts.VOCABULARY)
LIBRARY, OURS = Tokenizer.from_file(PATH), token_counts.counter(PATH)
FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


# letters that newer tables of Unicode know and older ones do not, signs that only some take for white space
ODD = [*"abZ'.,!<|>09éÉßİı́\u0085\x1c\x1f\xa0 \n\t日k_-@&²½٣　 ᠎​Ᲊ՘", "\U0001e5d0", "\U00031350", "<|endoftext|>", "don't", " 's", "  "]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(ODD)).map("".join))
def test_mixed_signs(text):
    assert OURS.count(text) == tokens(text)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    assert OURS.count(text) == tokens(text)


def test_long_pieces():
    for text in ("ab" * 40_000, "x" * 30_001, "the" * 9_999, "日本語" * 5_000, " " * 5_001, "\n " * 3_000, "!?" * 7_000, "the quick brown " * 4_000):
        assert OURS.count(text) == tokens(text)


def test_merging_by_hand():
    merges = token_counts.Merges([["b", "c"], ["a", "b"], ["ab", "c"], ["a", "bc"], ["a", "a"]])
    # abc: bc first, then a+bc; aaa: the leftmost pair; ab c has no bc between its symbols once ab is made
    assert [merges.count(p) for p in (b"", b"a", b"abc", b"aaa", b"aaaa", b"ab", b"abab", b"xyz")] == [0, 1, 1, 2, 2, 1, 2, 3]


def test_rows(docs, make):
    got = Counter(map(tuple, token_counts.token_counts(docs, limit=50).collect()))
    assert got == Counter((d, len((t or "").encode()), tokens(t), tokens(t) > 50) for d, t, *_ in awkward())
    assert token_counts.token_counts(make([])).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Counter(tokenizer_path())


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
def test_query(spark):
    rows = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    got = {tuple(r) for r in entry_module.queries()["op11_token_counts"](spark, FOLDER).collect()}
    assert got == {(d, len(t.encode()), tokens(t), tokens(t) > 1024) for d, t in rows}
