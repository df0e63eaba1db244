"""Token ids of whole texts, by the tokenizers library, each distinct word encoded once per worker.

The word-level vocabulary drops white space and never joins characters across it, so the ids of
a text are the ids of its white-space separated chunks in turn. Chunks repeat, encoding does not
have to: a worker keeps the ids of the chunks it has met lately, a bounded number. Most chunks are a
word of Latin letters, perhaps followed by punctuation. The vocabulary's rules make these one or
two units, which go to its merge model straight; everything else goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterable

import numpy as np

from gridcube.llm.common import Remembered

CACHE = 300_000  # chunks in each of the two generations a worker remembers
LATIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-;=-@\\[-`{}~]*)")

_encoders: dict = {}


def _byte_letters() -> list[str]:
    """The printable stand-in of every byte that byte-level vocabularies use."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Chunks:
    """Ids of single chunks as bytes."""

    def __init__(self, tokenizer, kind: str):
        self.tails: dict[str, bytes] = {}
        self.tokenizer, self.model, self.kind, self.letters = tokenizer, tokenizer.model, kind, _byte_letters()

    def ids(self, chunk: bytes) -> bytes:
        parts = LATIN.fullmatch(chunk.decode())
        ids = self._word(parts[1]) if parts else None
        if ids is None:
            ids = array(self.kind, self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids).tobytes()
        elif parts[2]:
            ids += self._tail(parts[2])
        return ids

    def _tail(self, marks: str) -> bytes:
        found = self.tails.get(marks)
        if found is None:
            found = array(self.kind, self.tokenizer.encode(marks, add_special_tokens=False).ids).tobytes()
            if len(marks) < 4:
                self.tails[marks] = found
        return found

    def _word(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters; None where it would not stay one unit."""
        if word.isascii():
            word = word.lower()
        else:
            word = "".join([c.lower() for c in unicodedata.normalize("NFC", word)])
            if not word.isalpha():
                return None
            letters = self.letters
            word = "".join([letters[b] for b in word.encode()])
        return array(self.kind, [t.id for t in self.model.tokenize(word)]).tobytes()


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        small = tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.dtype = np.dtype("<u2" if small else "<u4")
        self.tokenizer, self.known = tokenizer, Remembered(Chunks(tokenizer, "H" if small else "I").ids, CACHE)

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids per text; a null text is an empty one."""
        ids, out = self.known.__getitem__, []
        for text in texts:
            raw = (text or "").encode()
            # lower-casing ASCII early makes more chunks equal; special tokens are spelled case by case
            chunks = (raw if b"<|" in raw else raw.lower()).split()
            out.append(np.frombuffer(b"".join(map(ids, chunks)), self.dtype))
        return out


def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def in_parts(texts: list, most: int = 256):
    """(first, texts) a few at a time, so that ids of a whole batch are never held at once."""
    for at in range(0, len(texts), most):
        yield at, texts[at : at + most]
