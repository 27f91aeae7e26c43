"""Ids of a byte-level tokenizer, each distinct stretch of text encoded once.

The tokenizer splits a text into words with their leading space before it merges bytes. A text is
cut here only where that split certainly cuts too: before a space that a visible character follows,
and on both sides of a single line feed between visible characters. Stretches between two cuts
are encoded by the library, so the ids are those of the whole text, strings of added tokens included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from msgflow.llm.common import spans_of
from msgflow.llm.word_tokens import WordCache

# By first byte in UTF-8: characters that are certainly not white space (lead bytes C2, E1, E2 and E3 also start spaces).
_VISIBLE = np.zeros(256, np.bool_)
_VISIBLE[0x21:0x7F] = _VISIBLE[0xC3:0xE1] = _VISIBLE[0xE4:0xF5] = True
_ASCII_VISIBLE = np.zeros(256, np.bool_)
_ASCII_VISIBLE[0x21:0x7F] = True


# Letters that the tokenizer's split never parts from each other, and marks that stand alone after them.
_LETTERS = {chr(c) for c in range(0x250) if chr(c).isalpha()}
_MARKS = set(".,;:!?")
_CALL_WORDS = 5_000  # words of one call of the library, whose results are large objects


def _byte_names() -> dict[int, str]:
    """The characters that stand for bytes in the vocabulary: visible Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


_NAMES = _byte_names()


class ByteTokenizer(WordCache):
    CACHED = 400_000  # words kept; this kind runs beside a sort of texts

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)

    def split(self, texts: pa.Array) -> pa.Array:
        raw, starts = spans_of(texts)
        first, last = int(starts[0]), int(starts[-1])
        raw = raw[first:last]
        starts = starts - first
        cut = np.zeros(len(raw) + 1, np.bool_)
        if len(raw) > 1:
            seen = _VISIBLE[raw[1:]]
            cut[:-2] = (raw[:-1] == 0x20) & seen
            feed = np.flatnonzero((raw[1:-1] == 0x0A) & _ASCII_VISIBLE[raw[:-2]] & seen[1:]) + 1
            cut[feed] = cut[feed + 1] = True
        cut[starts] = True
        cut[-1] = True
        places = np.flatnonzero(cut)
        # An empty text adds no place: its list is empty.
        words = pa.Array.from_buffers(pa.large_string(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(raw)])
        return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(places, starts)), words)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        # A space, letters and a mark: the model is asked for the parts, which costs half of a call through the splitter.
        tokenize, space = self.tokenizer.model.tokenize, _NAMES[0x20]
        found: list[list[int]] = []
        rest: list[int] = []
        for i, word in enumerate(words):
            core = word[1:] if word[:1] == " " else word
            mark = core[-1:] if core[-1:] in _MARKS else ""
            letters = core[:-1] if mark else core
            if letters and _LETTERS.issuperset(letters):
                if not letters.isascii():
                    letters = letters.encode().decode("latin-1").translate(_NAMES)
                ids = [t.id for t in tokenize(space + letters if word[:1] == " " else letters)]
                if mark:
                    ids += [t.id for t in tokenize(mark)]
                found.append(ids)
            else:
                found.append([])
                rest.append(i)
        for start in range(0, len(rest), _CALL_WORDS):
            part = rest[start : start + _CALL_WORDS]
            for i, encoded in zip(part, self.tokenizer.encode_batch_fast([words[i] for i in part], add_special_tokens=False)):
                found[i] = encoded.ids
        return found
