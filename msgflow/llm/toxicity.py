"""Toxicity by subword-bag embeddings and a linear softmax.

A word stands for the hashed n-grams of its bytes, with marks at both ends, so an unseen
misspelling shares most vectors with the word it comes from. Vectors of all n-grams in a
window of words are averaged and go through a linear softmax; a text's score is that of its
worst window, so one insult is not diluted by a long text. Embeddings and softmax are trained
together in numpy: in each round the windows of labelled texts are scored, the worst one of
each toxic text counts as toxic, and random and the worst windows of the others as clean.

Training reads at most about `train_rows` labelled texts (`TRAIN_ROWS`, a bounded sample by a hash
of the id) on the driver. Scoring reads whole texts; per word only one number is kept.

Results for odd input: null and empty text and text without words get the score of the bias
alone; without labelled rows of both kinds every text gets the share of toxic labels (0 if
none); labels that are null count as absent, of several labels of a document the largest counts;
repeated rows are scored alike; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import bounded_sample, own_columns, release, spans_of

TRAIN_ROWS = 2_000  # of each label; further labelled rows are not read
TRAIN_BYTES = 12 << 20  # of text that is trained on at most
BUCKETS = 1 << 17
SIZES = (3, 4, 5)
WINDOW = 3
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # left out at both ends of a word
DIMENSIONS = 16
ROUNDS = 10
UPDATES = 150  # steps of 256 windows per round at least, however few labels there are
_SEED = 17
_LIMIT = 2 << 20  # bytes of text that are split at once


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of all texts: place of each in the list of distinct words, that list without punctuation at the ends, and the offsets of the texts."""
    folded = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    split = pc.utf8_split_whitespace(folded)
    encoded = split.flatten().dictionary_encode()
    offsets = split.offsets.to_numpy()
    return encoded.indices.to_numpy(), pc.utf8_trim(encoded.dictionary, PUNCTUATION), offsets - offsets[0]


def word_grams(words: pa.Array, buckets: int = BUCKETS, sizes: tuple[int, ...] = SIZES) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, and their offsets per word.

    Words are laid out with a start and an end mark. An n-gram that would pass the end mark
    is taken from the word's last n bytes, so every word has as many n-grams per size as bytes.
    """
    raw, starts = spans_of(words)
    lengths = np.diff(starts)
    n = len(lengths)
    marked = lengths + 2
    begin = np.concatenate([[0], np.cumsum(marked)])
    text = np.full(int(begin[-1]) + max(sizes), 0, np.uint64)
    text[begin[:-1]] = 1
    text[begin[1:] - 1] = 2
    inside = np.arange(int(lengths.sum())) + np.repeat(begin[:-1] + 1 - (starts[:-1] - starts[0]), lengths)
    text[inside] = raw[starts[0] : starts[-1]]
    positions = np.arange(int(begin[-1]))
    owner_end = np.repeat(begin[1:], marked)
    owner_begin = np.repeat(begin[:-1], marked)
    rolled = np.zeros(len(positions), np.uint64)
    hashed, done = [], 0
    for size in sorted(sizes):
        for j in range(done, size):
            rolled = rolled * np.uint64(0x100000001B3) + text[positions + j] + np.uint64(11)
        done = size
        # Beyond the end of the word, take the last n-gram that lies inside it.
        place = np.maximum(np.minimum(positions, owner_end - size), owner_begin)
        mixed = (rolled[place] ^ np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
        hashed.append((mixed >> np.uint64(40)).astype(np.int64) % buckets)
    grams = np.stack(hashed, axis=1).ravel() if n else np.zeros(0, np.int64)
    return grams, begin * len(sizes)


@dataclass
class ToxicityModel:
    """One number per n-gram bucket (its vector times the softmax's direction) and a bias."""

    values: np.ndarray
    bias: float
    constant: float | None = None
    window: int = WINDOW

    def word_sums(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        grams, offsets = word_grams(words, len(self.values))
        if len(words) == 0:
            return np.zeros(0), np.zeros(0)
        return np.add.reduceat(self.values[grams].astype(np.float64), offsets[:-1]), np.diff(offsets).astype(np.float64)

    def window_scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Softmax input of all windows, and the offsets of the texts; a text without words has one empty window."""
        place, words, offsets = split_words(texts)
        sums, counts = self.word_sums(words)
        starts, owners = window_starts(offsets, self.window)
        total = np.concatenate([[0.0], np.cumsum(sums[place])])
        number = np.concatenate([[0.0], np.cumsum(counts[place])])
        ends = np.minimum(starts + self.window, offsets[1:][np.searchsorted(owners, np.arange(len(starts)), side="right") - 1])
        mean = (total[ends] - total[starts]) / np.maximum(number[ends] - number[starts], 1.0)
        return mean + self.bias, owners

    def _worst(self, texts: pa.Array) -> np.ndarray:
        scores, owners = self.window_scores(texts)
        return np.maximum.reduceat(scores, owners[:-1])

    def score(self, texts: pa.Array) -> np.ndarray:
        """Score of each text; texts are taken in groups of bounded size."""
        if self.constant is not None or len(texts) == 0:
            return np.full(len(texts), self.constant or 0.0)
        rows = max(1, int(len(texts) * _LIMIT / max(1, texts.nbytes)))
        worst = np.concatenate([self._worst(texts.slice(start, rows)) for start in range(0, len(texts), rows)])
        return 1.0 / (1.0 + np.exp(-np.clip(worst, -500, 500)))


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All integers of some ranges, one range after the other."""
    sizes = end - begin
    before = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(before[-1]) + np.repeat(begin - before[:-1], sizes)


def window_starts(offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window, and the offsets of the texts in that list; windows do not overlap and do not cross texts."""
    counts = np.maximum(1, -(-np.diff(offsets) // window))
    owners = np.concatenate([[0], np.cumsum(counts)])
    inside = np.arange(owners[-1]) - np.repeat(owners[:-1], counts)
    return np.repeat(offsets[:-1], counts) + inside * window, owners


def train_model(texts: list[str], toxic: list[int], rounds: int = ROUNDS, seed: int = _SEED) -> ToxicityModel:
    """Embeddings and softmax, trained jointly with Adagrad."""
    labels = np.array(toxic, np.int64)
    if len(set(toxic)) < 2:
        return ToxicityModel(np.zeros(1, np.float32), 0.0, constant=float(labels.mean()) if len(labels) else 0.0)
    rng = np.random.default_rng(seed)
    place, words, offsets = split_words(pa.array(texts, pa.large_string()))
    grams, gram_offsets = word_grams(words)
    starts, owners = window_starts(offsets, WINDOW)
    owner = np.repeat(np.arange(len(labels)), np.diff(owners))
    ends = np.minimum(starts + WINDOW, offsets[1:][owner])
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    softmax = rng.uniform(-1, 1, (DIMENSIONS, 2)).astype(np.float32) / DIMENSIONS
    bias = np.zeros(2, np.float32)
    caches = [np.full_like(vectors, 1e-4), np.full_like(softmax, 1e-4), np.full_like(bias, 1e-4)]

    def bag(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-gram buckets of some windows, a random half of them, and the offsets of the windows.

        Leaving out half makes every n-gram of a word carry weight, so misspellings that keep some of them are found.
        """
        used = _ranges(starts[windows], ends[windows])
        picked = place[used]
        found = grams[_ranges(gram_offsets[picked], gram_offsets[picked + 1])]
        sizes = np.diff(gram_offsets)[picked]
        window = np.repeat(np.repeat(np.arange(len(windows)), ends[windows] - starts[windows]), sizes)
        kept = rng.random(len(found)) < 0.5
        return found[kept], np.concatenate([[0], np.cumsum(np.bincount(window[kept], minlength=len(windows)))])

    def step(windows: np.ndarray, target: np.ndarray, rate: float) -> None:
        nonlocal bias
        buckets, edge = bag(windows)
        used = np.diff(edge) > 0
        edge, target = np.concatenate([edge[:-1][used], edge[-1:]]), target[used]
        if len(target) == 0:
            return
        size = np.diff(edge)[:, None]
        mean = np.add.reduceat(vectors[buckets], edge[:-1], axis=0) / size
        z = mean @ softmax + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(target)), target] -= 1.0
        p /= len(target)
        for value, gradient, cache in ((softmax, mean.T @ p, caches[1]), (bias, p.sum(axis=0), caches[2])):
            cache += gradient**2
            value -= rate * gradient / np.sqrt(cache)
        back = np.repeat((p @ softmax.T) / size, np.diff(edge), axis=0)
        distinct, where = np.unique(buckets, return_inverse=True)
        gradient = np.stack([np.bincount(where, back[:, d], len(distinct)) for d in range(DIMENSIONS)], axis=1).astype(np.float32)
        caches[0][distinct] += gradient**2
        vectors[distinct] -= rate * gradient / np.sqrt(caches[0][distinct])

    def scored() -> np.ndarray:
        direction = vectors @ (softmax[:, 1] - softmax[:, 0])
        sums = np.add.reduceat(direction[grams].astype(np.float64), gram_offsets[:-1])[place]
        total = np.concatenate([[0.0], np.cumsum(sums)])
        number = np.concatenate([[0], np.cumsum(np.diff(gram_offsets)[place])])
        return (total[ends] - total[starts]) / np.maximum(number[ends] - number[starts], 1) + float(bias[1] - bias[0])

    bad = labels[owner] == 1
    clean = np.flatnonzero(~bad)
    for turn in range(rounds):
        if turn == 0:
            positives = rng.permutation(np.flatnonzero(bad))[:8_000]
            negatives = rng.permutation(clean)[: len(positives)]
        else:
            scores = scored()
            order = np.lexsort((-scores, owner))
            worst = order[owners[:-1]]  # the worst window of each text
            positives = worst[labels == 1]
            sure = np.flatnonzero(bad & (scores > np.quantile(scores[clean], 0.999)))
            positives = np.unique(np.concatenate([positives, rng.permutation(sure)[:3_000]]))
            negatives = np.unique(np.concatenate([worst[labels == 0], rng.permutation(clean)[: 2 * len(positives)]]))
        windows = np.concatenate([positives, negatives])
        target = np.concatenate([np.ones(len(positives), np.int64), np.zeros(len(negatives), np.int64)])
        for _ in range(max(2 if turn == 0 else 4, -(-UPDATES * 256 // max(1, len(windows))))):
            shuffled = rng.permutation(len(windows))
            for start in range(0, len(shuffled), 256):
                part = shuffled[start : start + 256]
                step(windows[part], target[part], 0.15)
    model = ToxicityModel((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))
    # The bias is set for whole texts: halfway between what clean texts reach and what toxic ones do.
    scores = np.maximum.reduceat(scored(), owners[:-1])
    high, low = np.quantile(scores[labels == 0], 0.998), np.quantile(scores[labels == 1], 0.02)
    model.bias -= (high + low) / 2
    return model


def training_texts(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS) -> tuple[list[str], list[int]]:
    """Whole texts and labels of a bounded sample: at most about `rows` of each label and `TRAIN_BYTES` of text."""
    known = labels.where(F.col("toxic").isin(0, 1) & learn).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = [bounded_sample(known.where(F.col("toxic") == label), "doc_id", rows, _SEED) for label in (0, 1)]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))  # ids of a bounded sample
    texts = own_columns(docs, {"doc_id": "doc_id", "text": "text"}).join(picked, "doc_id").where("text IS NOT NULL")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > TRAIN_BYTES:
        texts = texts.where(F.pmod(F.xxhash64(F.lit(_SEED + 1), "doc_id"), F.lit(1 << 30)) < int(TRAIN_BYTES / size * (1 << 30)))
    found = sorted(((r["doc_id"], r["text"], r["toxic"]) for r in texts.toLocalIterator()), key=lambda r: (r[0], r[1]))
    return [r[1] for r in found], [r[2] for r in found]


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """uid, doc_id and score (0 to 1) of every document."""
    values = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket: 512 KB

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(values.value.score(batch.column(2)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), score], names=["uid", "doc_id", "score"])
            release()

    rows = own_columns(docs, {"doc_id": "doc_id", "text": "text"})
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(scored, "uid bigint, doc_id bigint, score double")
