"""Runs: maximal stretches of a text's words that repeat with a period at least twice.

Runs are found in an enhanced suffix array of the words (suffix array, its inverse, longest common
prefixes). For every interval of common prefix length d the suffixes of all children but the
largest are tested: if the suffix d words on (or back) lies in the same interval but in another
child, a square of period d begins here (or there) that cannot be rotated to the right. Each run
ends in just one such square of its period. Squares are then rotated to the left as far as words
agree, shortest period first; a square whose root is itself a power lies in the run found before it
and is merged into that. Intervals are kept as ranks of their borders; there is no tree.

A run of at least `min_words` words and two periods repeats a stretch of `min_words` / 2 words, so texts in
which hashes of such stretches never repeat need no suffix array.

Texts are judged on their own rows: no shuffle, and a task holds one batch of texts.

Results for odd input: a null or empty text has no words and no runs; a null id takes part like any
other; repeated rows are judged alike; a very long text needs memory in proportion to its words; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import bounds, own_columns, release, spans_of

MIN_WORDS = 12
_SUFFIXES = 1 << 20  # words whose suffixes are sorted at once; a longer text alone
_JOINED = 1 << 20  # words joined at once
_SPACE = np.zeros(256, np.bool_)
_SPACE[0x20] = _SPACE[0x09:0x0E] = True

RUNS = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed_sha256 string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every stretch, one stretch after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


@dataclass
class Words:
    """Words of several texts: their bytes without white space, where each begins, and the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    texts: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Words:
        raw, spans = spans_of(column)
        raw, spans = raw[spans[0] : spans[-1]], spans - spans[0]
        seen = ~_SPACE[raw]
        begins = seen.copy()
        begins[1:] &= ~seen[:-1]
        inner = spans[1:-1]
        inner = inner[inner < len(raw)]
        begins[inner] = seen[inner]
        places = np.flatnonzero(begins)
        data = raw[seen]
        # Place of a word among the bytes that are kept: bytes before it less the white space before it.
        spaces = np.flatnonzero(~seen)
        starts = places - np.searchsorted(spaces, places)
        return cls(data, np.append(starts, len(data)), np.searchsorted(places, spans))

    def codes(self) -> np.ndarray:
        """A number for each word, equal for equal words."""
        words = pa.Array.from_buffers(pa.large_binary(), len(self.starts) - 1, [None, pa.py_buffer(self.starts), pa.py_buffer(self.data)])
        return words.dictionary_encode().indices.to_numpy().astype(np.int64)

    def joined_digests(self, chosen: np.ndarray, texts: np.ndarray) -> list[str]:
        """SHA-256 of each text's chosen words joined by one space; `texts` holds where each text's words begin in `chosen`."""
        digests, hashed, text = [], hashlib.sha256(), 0
        for block in range(0, max(1, len(chosen)), _JOINED):
            words = chosen[block : block + _JOINED]
            lengths = self.starts[words + 1] - self.starts[words]
            places = np.concatenate([[0], np.cumsum(lengths + 1)])
            out = np.full(int(places[-1]), 0x20, np.uint8)
            out[ragged(places[:-1], lengths)] = self.data[ragged(self.starts[words], lengths)]
            view, end, start = memoryview(out), block + len(words), block
            while text < len(texts) - 1 and texts[text + 1] <= end:
                last = int(texts[text + 1])
                if last > texts[text]:
                    hashed.update(view[places[start - block] : places[last - block] - 1])
                digests.append(hashed.hexdigest())
                hashed, start, text = hashlib.sha256(), last, text + 1
            if start < end:
                hashed.update(view[places[start - block] :])
        return digests


def repeats_stretch(codes: np.ndarray, texts: np.ndarray, width: int) -> np.ndarray:
    """Whether a stretch of `width` words occurs twice in a text (or, rarely, two have one hash)."""
    count = len(texts) - 1
    owner = np.repeat(np.arange(count), np.diff(texts))
    if len(codes) < width:
        return np.zeros(count, np.bool_)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    places = len(codes) - width + 1
    hashed = owner[:places].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for step in range(width):
        hashed = (hashed ^ mixed[step : step + places]) * np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
    inside = owner[:places] == owner[width - 1 :]
    ordered = np.sort(hashed[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    found = np.zeros(count, np.bool_)
    if len(twice):
        found[np.unique(owner[:places][inside & np.isin(hashed, twice)])] = True
    return found


def suffix_array(codes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, inverse and longest common prefixes with the suffix before, of several texts one after the other.

    Suffixes end with their text and are ordered by text first, so suffixes of different
    texts have nothing in common. Suffixes that still tie are sorted by twice as many words per round.
    """
    n = len(codes)
    owner = np.repeat(np.arange(len(texts) - 1), np.diff(texts))
    ends = texts[1:][owner]
    keys = owner * (int(codes.max(initial=0)) + 1) + codes
    array = np.argsort(keys, kind="stable")
    slots, keys = np.arange(n), keys[array]
    rank = np.zeros(n + 1, np.int64)
    rank[n] = -1
    levels, width = [], 1
    while len(slots):
        edge = bounds(keys)
        sizes = np.diff(edge)
        rank[array[slots]] = np.repeat(slots[edge[:-1]], sizes)
        levels.append(rank.astype(np.int32))
        slots = slots[np.repeat(sizes > 1, sizes)]
        suffixes = array[slots]
        beyond = suffixes + width
        second = np.where(beyond < ends[suffixes], rank[np.minimum(beyond, n)], -1)
        keys = rank[suffixes] * (n + 1) + second + 1
        order = np.argsort(keys, kind="stable")
        array[slots], keys = suffixes[order], keys[order]
        width *= 2
    inverse = np.full(n + 1, -1, np.int64)
    inverse[array] = np.arange(n)
    # Common prefixes: the ranks by 2^k words are equal when that many words are.
    common = np.zeros(n + 1, np.int64)
    pairs = np.flatnonzero(levels[0][array[1:]] == levels[0][array[:-1]]) + 1 if n else np.zeros(0, np.int64)
    left, right = array[pairs - 1], array[pairs]
    for k in range(len(levels) - 1, -1, -1):
        step = (levels[k][left] == levels[k][right]).astype(np.int64) << k
        left, right = left + step, right + step
        common[pairs] += step
    return array, inverse, common


def _next_smaller(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each place the nearest later place with a smaller value; the last value is smaller than those of all places.

    Binary descent in tables of minima over 2^k values.
    """
    tables = [values]
    # Long enough for the longest stretch of values above the least one.
    low = np.flatnonzero(values < values[places].min(initial=1))
    longest = int(np.diff(low).max(initial=1)) if len(low) else len(values)
    while (1 << len(tables)) <= longest:
        half = 1 << (len(tables) - 1)
        last = tables[-1]
        merged = last.copy()
        merged[:-half] = np.minimum(last[:-half], last[half:])
        merged[-half:] = values[-1]
        tables.append(merged)
    found = places + 1
    for k in range(len(tables) - 1, -1, -1):
        inside = found < len(values)
        above = inside & (tables[k][np.minimum(found, len(values) - 1)] >= values[places])
        found = found + (above.astype(np.int64) << k)
    return found


def branching_squares(array: np.ndarray, inverse: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where squares begin that cannot be rotated to the right, and their periods."""
    n = len(array)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    values = common[: n + 1].copy()
    values[0] = values[n] = -1
    border = np.flatnonzero(values > 0)
    if not len(border):
        return none
    right = _next_smaller(values, border)
    left = n - _next_smaller(values[::-1].copy(), (n - border)[::-1])[::-1]
    depth = values[border]
    # Borders of one interval stand together; its children lie between them.
    order = np.lexsort((border, depth, left))
    border, depth, left, right = border[order], depth[order], left[order], right[order]
    first = np.ones(len(border), np.bool_)
    first[1:] = (left[1:] != left[:-1]) | (depth[1:] != depth[:-1])
    interval = np.cumsum(first) - 1
    last = np.append(first[1:], True)
    begins = np.concatenate([np.where(first, left, np.append(0, border[:-1])), border[last]])
    ends = np.concatenate([border, right[last]])
    interval = np.concatenate([interval, interval[last]])
    d, low, high = depth[first][interval], left[first][interval], right[first][interval]
    # All children but a largest one of each interval.
    order = np.lexsort((ends - begins, interval))
    smaller = order[:-1][interval[order][1:] == interval[order][:-1]]
    begins, ends, d, low, high = begins[smaller], ends[smaller], d[smaller], low[smaller], high[smaller]
    sizes = ends - begins
    suffix = array[ragged(begins, sizes)]
    begins, ends, d, low, high = (np.repeat(x, sizes) for x in (begins, ends, d, low, high))

    def elsewhere(other: np.ndarray) -> np.ndarray:
        rank = inverse[np.where((other >= 0) & (other < n), other, n)]
        return (rank >= low) & (rank < high) & ~((rank >= begins) & (rank < ends))

    ahead, back = elsewhere(suffix + d), elsewhere(suffix - d)
    found = np.unique(np.stack([np.concatenate([suffix[ahead], suffix[back] - d[back]]), np.concatenate([d[ahead], d[back]])], axis=1), axis=0)
    return found[:, 0], found[:, 1]


def _rotated(codes: np.ndarray, start: np.ndarray, period: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Starts of squares after rotating them to the left as far as the words agree, not beyond `floor`."""
    start, active, width = start.copy(), np.arange(len(start)), 16
    while len(active):
        back = start[active, None] - np.arange(1, width + 1)
        agree = back >= floor[active, None]
        back = np.maximum(back, 0)
        agree &= codes[back] == codes[back + period[active, None]]
        steps = np.where(agree.all(axis=1), width, agree.argmin(axis=1))
        start[active] -= steps
        active = active[steps == width]
        width = max(16, min(2 * width, (1 << 20) // max(1, len(active))))
    return start


def find_runs(codes: np.ndarray, texts: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least `min_words` words, by start, then period.

    `texts` holds the first word of each text and the end; starts count over all texts.
    """
    array, inverse, common = suffix_array(codes, texts)
    start, period = branching_squares(array, inverse, common)
    end = start + 2 * period
    order = np.lexsort((period, end))
    start, period, end = start[order], period[order], end[order]
    floor = texts[np.searchsorted(texts, start, "right") - 1]
    runs = [np.zeros((0, 3), np.int64)]
    while len(end):
        edge = bounds(end)
        first = edge[:-1]
        begin = _rotated(codes, start[first], period[first], floor[first])
        length = end[first] - begin
        runs.append(np.stack([begin, length, period[first]], axis=1))
        sizes = np.diff(edge)
        shortest, reach = np.repeat(period[first], sizes), np.repeat(length, sizes)
        rest = ~((period % shortest == 0) & (2 * period <= reach))
        start, period, end, floor = start[rest], period[rest], end[rest], floor[rest]
    found = np.concatenate(runs)
    found = found[found[:, 1] >= min_words]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _groups(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Stretches of texts with at most `limit` words together, a longer text alone."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def text_runs(codes: np.ndarray, texts: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """`find_runs` with suffix arrays for those texts only that repeat half as many words as a run has."""
    chosen = np.flatnonzero(repeats_stretch(codes, texts, max(1, (min_words + 1) // 2)))
    sizes = np.diff(texts)[chosen]
    found = [np.zeros((0, 3), np.int64)]
    for a, b in _groups(sizes, _SUFFIXES):
        inner = np.concatenate([[0], np.cumsum(sizes[a:b])])
        runs = find_runs(codes[ragged(texts[chosen[a:b]], sizes[a:b])], inner, min_words)
        text = np.searchsorted(inner, runs[:, 0], "right") - 1
        runs[:, 0] += texts[chosen[a:b]][text] - inner[text]
        found.append(runs)
    return np.concatenate(found)


def _judged(min_words: int, order_of: Callable[[int | None, int], np.ndarray | None] | None):
    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words.of(batch.column(1))
            texts, chosen = words.texts, np.arange(len(words.starts) - 1)
            if order_of:
                for i, doc_id in enumerate(batch.column(0).to_pylist()):
                    order = order_of(doc_id, int(texts[i + 1] - texts[i]))
                    if order is not None:
                        chosen[texts[i] : texts[i + 1]] = texts[i] + order
            runs = text_runs(words.codes()[chosen], texts, min_words)
            # A word goes when a run holds it after the run's first period.
            change = np.zeros(len(chosen) + 1, np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 0] + runs[:, 1], -1)
            kept = np.cumsum(change[:-1]) == 0
            digests = words.joined_digests(chosen[kept], np.concatenate([[0], np.cumsum(kept)])[texts])
            text = np.searchsorted(texts, runs[:, 0], "right") - 1
            offsets = np.searchsorted(text, np.arange(batch.num_rows + 1))
            fields = [pa.array(runs[:, 0] - texts[text]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_RUN)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(texts)), lists, pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed_sha256"],
            )
            release()

    return judge


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
    order_of: Callable[[int | None, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """Runs of every text, by start and period, and the digest of what is left when every run is cut to its first period.

    `order_of` may give, for a document id and its number of words, the numbers of the words
    to judge in place of the text's own order.
    """
    rows = own_columns(docs, {"doc_id": id_col, "text": text_col}).select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(_judged(min_words, order_of), RUNS)


def digest_runs(found: DataFrame) -> DataFrame:
    """The number of runs, the longest one, and digests, of `periodic_runs`: one row per document."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumns({"best": longest, "lines": F.array_join(lines, "")})
    length, period = -F.col("best.l"), F.col("best.p")
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.s").alias("start"), length.alias("length"), period.alias("period"),
        F.expr("(-best.l * 1000) div best.p").alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"), "collapsed_sha256",
    )
