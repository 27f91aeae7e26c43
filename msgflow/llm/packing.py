"""Hierarchical multi-length packing of tokenised documents.

A document of n ids gives full windows of the longest context and one remainder, which is
routed to the smallest context size (tier) that holds it. Windows of every tier, longest
first, start with a remainder of that tier; the gap is filled with whole remainders of
shorter tiers, the longest that fits first, and what is still open is cut from the shortest
longer one. So windows are full, and documents are cut only where nothing whole fits. Windows
of all lengths are then dealt to step groups of about equal tokens, longest first.

The work needs no shuffle: each task packs its own documents, holding at most
`buffer_tokens` of remainders; what does not fill a window waits for the next documents. The
last ids of a task go to windows of power-of-two lengths, and fewer than the shortest tier to
one padded window. Sequence ids hold the partition above 40 bits and are the same on every attempt.

Results for odd input: null and empty text is the end id alone; repeated rows and equal or
null ids are packed like others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from msgflow.llm.common import own_columns, release
from msgflow.llm.word_tokens import WordTokenizer

TIERS = (256, 512, 1024, 2048)
END_ID = 1
BUFFER_TOKENS = 1 << 19
STEP_TOKENS = 1 << 16
_PART_BITS = 40

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "tier int, sequence_tokens int, step_group bigint"
)


@dataclass(order=True)
class Item:
    """A stretch of a document that waits for a window."""

    length: int
    number: int  # order of arrival: ties are settled the same way on every attempt
    start: int = field(compare=False)
    doc: int = field(compare=False)


@dataclass
class Window:
    tier: int
    tokens: int = 0
    items: list[Item] = field(default_factory=list)


def tier_of(length: int, tiers: tuple[int, ...] = TIERS) -> int:
    """The smallest context size that holds a length of at most the longest one."""
    return tiers[bisect_left(tiers, length)]


class Packer:
    """Packs remainders as they come; `windows` takes out what is full."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers, self.waiting, self.total, self.number = tiers, [], 0, 0

    def add(self, doc: int, start: int, length: int) -> None:
        if length:
            insort(self.waiting, Item(length, self.number, start, doc))
            self.number += 1
            self.total += length

    def _take(self, place: int, window: Window) -> None:
        item = self.waiting.pop(place)
        window.items.append(item)
        window.tokens += item.length
        self.total -= item.length

    def _cut(self, place: int, window: Window, length: int) -> None:
        """The first ids of an item go to the window; the rest waits on, in the tier of its new length."""
        item = self.waiting.pop(place)
        window.items.append(Item(length, item.number, item.start, item.doc))
        window.tokens += length
        self.total -= length
        insort(self.waiting, Item(item.length - length, item.number, item.start + length, item.doc))

    def _window(self, tier: int) -> Window:
        """A full window; there are at least as many ids."""
        window = Window(tier)
        while window.tokens < tier:
            gap = tier - window.tokens
            fits = bisect_right(self.waiting, gap, key=lambda item: item.length)
            if fits:
                self._take(fits - 1, window)
            else:
                self._cut(0, window, gap)
        return window

    def windows(self, last: bool = False) -> Iterator[Window]:
        """Full windows of the tiers, longest tier first; with `last` the rest as well."""
        for tier, below in zip(self.tiers[::-1], [*self.tiers[-2::-1], 0]):
            # A window of this tier is opened while a remainder is routed to it.
            while self.total >= tier and self.waiting[-1].length > below:
                yield self._window(tier)
        if last:
            for tier in self.tiers[::-1]:
                while self.total >= tier:
                    yield self._window(tier)
            if self.total:
                window = Window(self.tiers[-1])
                while self.waiting:
                    self._take(len(self.waiting) - 1, window)
                yield window


def step_groups(tokens: list[int], step_tokens: int) -> list[int]:
    """A group for each window: windows are dealt longest first to the group with the fewest tokens."""
    groups = max(1, round(sum(tokens) / step_tokens))
    load = [(0, group) for group in range(groups)]
    result = [0] * len(tokens)
    for i in sorted(range(len(tokens)), key=lambda i: (-tokens[i], i)):
        held, group = heapq.heappop(load)
        result[i] = group
        heapq.heappush(load, (held + tokens[i], group))
    return result


def _packed(tokenizer: Callable[[], WordTokenizer], tiers, buffer_tokens, step_tokens):
    longest = tiers[-1]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer()
        part = TaskContext.get().partitionId() << _PART_BITS
        packer, full, held = Packer(tiers), [], {}  # held: ids of documents that still have a waiting stretch
        doc_ids, totals, docs, sequence, group, buffered = {}, {}, 0, 0, 0, 0

        def out(windows: list[Window]) -> pa.RecordBatch:
            nonlocal sequence, group
            dealt = step_groups([w.tokens for w in windows], step_tokens)
            rows = []
            for window, step in zip(windows, dealt):
                offset = 0
                for item in window.items:
                    piece = held[item.doc][item.start : item.start + item.length]
                    rows.append((doc_ids[item.doc], item.start, item.length, zlib.crc32(piece.tobytes()), totals[item.doc],
                                 part + sequence, offset, window.tier, window.tokens, part + group + step))
                    offset += item.length
                sequence += 1
            group += max(dealt, default=-1) + 1
            waiting = {item.doc for item in packer.waiting}
            for doc in [d for d in held if d not in waiting]:
                del held[doc], doc_ids[doc], totals[doc]
            names = [f.split()[0] for f in PIECES.split(", ")]
            kinds = [pa.int32() if f.endswith(" int") else pa.int64() for f in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1))):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                held[docs], doc_ids[docs], totals[docs] = ids, doc_id, len(ids)
                whole = len(ids) // longest * longest
                full += [Window(longest, longest, [Item(longest, 0, start, docs)]) for start in range(0, whole, longest)]
                packer.add(docs, whole, len(ids) - whole)
                docs += 1
                buffered += len(ids)
                if buffered >= buffer_tokens:
                    windows = full + list(packer.windows())
                    if windows:
                        yield out(windows)
                    full, buffered = [], packer.total
                    release()
        windows = full + list(packer.windows(last=True))
        if windows:
            yield out(windows)

    return pack


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", tiers: tuple[int, ...] = TIERS,
    buffer_tokens: int = BUFFER_TOKENS, step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Sequences have the length of a tier; only the last one of a task may be shorter, and it
    is padded to the longest tier. `step_group` names the group of sequences that is trained
    on in one step.
    """
    rows = own_columns(docs, {"doc_id": id_col, "text": text_col})
    rows = rows.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    return rows.mapInArrow(_packed(lambda: WordTokenizer.shared(tokenizer_path), tiers, buffer_tokens, step_tokens), PIECES)
