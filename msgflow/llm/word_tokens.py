"""Ids of texts whose words are encoded one by one, each distinct word once.

A batch is split and reduced to distinct words by Arrow; only words that the Python worker has
not met before reach the tokenizer.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

CACHED_WORDS = 600_000  # words kept, so that memory stays bounded; frequent ones are met early, the rest is encoded per group
_PLAIN = set("abcdefghijklmnopqrstuvwxyz")


def _with_room(values: np.ndarray, used: int, needed: int) -> np.ndarray:
    """The array, or one of twice the size with the used part of it."""
    if needed <= len(values):
        return values
    grown = np.zeros(max(needed, 2 * len(values)), values.dtype)
    grown[:used] = values[:used]
    return grown


class WordCache:
    """Splits texts into words and keeps the ids of words met before; what a word is and how it is encoded is up to the kind."""

    _shared: dict[tuple, WordCache] = {}
    GROUP_BYTES = 4 << 20  # text that is split at once
    CACHED = CACHED_WORDS

    @classmethod
    def shared(cls, path: str):
        """One per Python worker, kind and file."""
        if (cls, path) not in cls._shared:
            cls._shared[cls, path] = cls(path)
        return cls._shared[cls, path]

    def __init__(self, path: str):
        self.place: dict[str, int] = {}
        # Ids of word i are ids[starts[i]:starts[i + 1]]. Both arrays have room to spare; words that are not kept stand behind the kept ones for a while.
        self.starts, self.ids = np.zeros(1 << 10, np.int64), np.zeros(1 << 12, np.uint32)

    def split(self, texts: pa.Array) -> pa.Array:
        raise NotImplementedError

    def encode_words(self, words: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _append(self, first: int, found: list[list[int]]) -> None:
        """Puts the ids of some words behind those of the first ones."""
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        begin = int(self.starts[first])
        ends = begin + np.cumsum(sizes)
        end = int(ends[-1])
        self.starts = _with_room(self.starts, first + 1, first + 1 + len(found))
        self.ids = _with_room(self.ids, begin, end)
        self.starts[first + 1 : first + 1 + len(found)] = ends
        self.ids[begin:end] = np.fromiter(chain.from_iterable(found), np.uint32, end - begin)

    def _encode_group(self, texts: pa.Array) -> Iterator[np.ndarray]:
        split = self.split(texts)
        encoded = split.flatten().dictionary_encode()
        words = encoded.dictionary.to_pylist()
        place = np.fromiter((self.place.get(word, -1) for word in words), np.int64, len(words))
        new = np.flatnonzero(place < 0)
        if len(new):
            unknown = [words[i] for i in new.tolist()]
            first, last = len(self.place), len(self.place) + len(new)
            place[new] = np.arange(first, last)
            self._append(first, self.encode_words(unknown))
            self.place.update(zip(unknown[: max(0, self.CACHED - first)], range(first, last)))
        starts, ids = self.starts, self.ids
        used = place[encoded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        begins = starts[used]
        lengths = starts[used + 1] - begins
        ends = np.concatenate([[0], np.cumsum(lengths)])
        flat = ids[np.arange(ends[-1]) + np.repeat(begins - ends[:-1], lengths)]
        offsets = split.offsets.to_numpy()
        cuts = ends[offsets - offsets[0]]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield flat[a:b]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of every text as uint32; null is empty. Texts are taken in groups of bounded size, a longer one alone."""
        texts = texts.cast(pa.large_string()).fill_null("")
        sizes = pc.binary_length(texts).to_numpy()
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > self.GROUP_BYTES:
                yield from self._encode_group(texts.slice(start, i - start))
                start, held = i, 0
            held += size
        if start < len(texts):
            yield from self._encode_group(texts.slice(start))


class WordTokenizer(WordCache):
    """A tokenizer that never joins characters across a space or line feed: a text's ids are those of its words in order."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Texts that hold the string of an added token, in any case, go to the library as they are."""
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = np.zeros(len(texts), np.bool_)
        for content in self.added:
            whole |= pc.match_substring(texts, content, ignore_case=True).to_numpy(zero_copy_only=False)
        places = np.flatnonzero(whole)
        if not len(places):
            yield from super().encode(texts)
            return
        others = super().encode(texts.filter(pa.array(~whole)))
        for i, alone in enumerate(whole.tolist()):
            if alone:
                yield np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
            else:
                yield next(others)

    def split(self, texts: pa.Array) -> pa.Array:
        # Folding A-Z before the tokenizer's own lower-casing changes nothing but the number of distinct words.
        return pc.split_pattern(pc.ascii_lower(pc.replace_substring(texts, "\n", " ")), " ")

    def encode_words(self, words: list[str]) -> list[list[int]]:
        model = self.tokenizer.model
        found: list[list[int]] = []
        rest: list[tuple[int, str]] = []
        for i, word in enumerate(words):
            # Plain letters are one unit for the model: no normalisation or splitting applies to them.
            if word and _PLAIN.issuperset(word):
                found.append([t.id for t in model.tokenize(word)])
            elif len(word) > 1 and word[-1] in ".,;!?" and _PLAIN.issuperset(word[:-1]):
                found.append([t.id for w in (word[:-1], word[-1]) for t in model.tokenize(w)])
            else:
                found.append([])
                rest.append((i, word))
        for (i, _), encoded in zip(rest, self.tokenizer.encode_batch_fast([w for _, w in rest], add_special_tokens=False)):
            found[i] = encoded.ids
        return found
