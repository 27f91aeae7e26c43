"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built from a bounded sample of labelled text. A text
is parsed into phrases, each the longest match that the automaton still accepts; a language
the text resembles needs few, long phrases. The number of phrases, times the logarithm of the
training length, per character, estimates the cross entropy; the lowest wins. That factor makes samples of
different lengths comparable, so no language's sample depends on another's.

Texts are parsed in blocks of `BLOCK` characters, each of which starts a new phrase, all blocks of a
batch and all languages in step. Whole texts are parsed; a long one is only more blocks.

Every character of every sample has a class of its own, whatever the number of alphabets. The
transitions lie in one array, rows of states pushed into each other's gaps, so memory grows with
the length of the samples and not with the number of different characters.

Results for odd input: null text and text without a letter is `und` with score 0; equal
entropies go to the language that sorts first; without any labelled text everything is `und`;
repeated rows get equal results; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import own_columns, release

TRAIN_CHARS = 16_000  # characters of labelled text per language
TRAIN_ROWS = 400  # labelled texts per language that are read for it
BLOCK = 512
FLOOR_CHARS = 4_000  # shorter samples count as this long: a few characters must not make phrases cheap
UNDETERMINED = "und"
_SEED = 29
_LANES = 12_000  # blocks parsed in step
_REACH = 512  # places before the end of those taken where a row of several transitions may begin
_SPACE = re.compile(r"[\W\d_]+")


def normalised(text: str) -> str:
    """Lower case, with every stretch that holds no letter as one space."""
    return _SPACE.sub(" ", text.lower())


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring; state 0 is the start."""
    step, link, longest = [{}], [-1], [0]
    last = 0
    for code in codes:
        current = len(step)
        step.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p >= 0 and code not in step[p]:
            step[p][code] = current
            p = link[p]
        if p >= 0:
            q = step[p][code]
            if longest[q] == longest[p] + 1:
                link[current] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                while p >= 0 and step[p].get(code) == q:
                    step[p][code] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    return step


def packed_rows(steps: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the transitions of an automaton: the start of each state's row, and owner (-1 for none) and target of each place.

    The transition of a state with a class lies at start + class. Rows overlap where no two transitions
    share a place; states with most transitions are placed first and near the end, those with one fill all gaps.
    """
    total = sum(map(len, steps))
    room = 2 * total + 2 * width + 2
    owner, target, start = np.full(room, -1, np.int32), np.zeros(room, np.int32), np.zeros(len(steps), np.int64)
    top = width  # end of the places taken
    for state in sorted((s for s in range(len(steps)) if len(steps[s]) > 1), key=lambda s: -len(steps[s])):
        codes = np.fromiter(steps[state], np.int64)
        at, tried = max(width, top - _REACH) - int(codes.min()), _REACH
        while True:
            if at + tried + width > len(owner):
                owner = np.concatenate([owner, np.full(len(owner) + tried, -1, np.int32)])
                target = np.concatenate([target, np.zeros(len(owner) - len(target), np.int32)])
            free = np.flatnonzero((owner[at + np.arange(tried)[:, None] + codes] < 0).all(axis=1))
            if len(free):
                break
            at += tried
        start[state] = at + free[0]
        owner[start[state] + codes], target[start[state] + codes] = state, np.fromiter(steps[state].values(), np.int32)
        top = max(top, int(start[state] + codes.max()) + 1)
    single = [s for s in range(len(steps)) if len(steps[s]) == 1]
    places = width + np.flatnonzero(owner[width:] < 0)
    if len(places) < len(single):
        more = len(single) - len(places)
        places = np.concatenate([places, np.arange(len(owner), len(owner) + more)])
        owner, target = np.concatenate([owner, np.full(more, -1, np.int32)]), np.concatenate([target, np.zeros(more, np.int32)])
    places = places[: len(single)]
    start[single] = places - np.array([next(iter(steps[s])) for s in single], np.int64)
    owner[places] = single
    target[places] = [next(iter(steps[s].values())) for s in single]
    end = max(int(np.flatnonzero(owner >= 0)[-1]) + 1 if total else 0, int(start.max(initial=0))) + width  # any class may be looked up in any row
    grown = max(0, end - len(owner))
    return start, np.concatenate([owner, np.full(grown, -1, np.int32)])[:end], np.concatenate([target, np.zeros(grown, np.int32)])[:end]


@dataclass
class LanguageModel:
    """Automata of all languages in one array of transitions (`packed_rows`); states are numbered through, 0 = none."""

    languages: list[str]
    points: np.ndarray  # code points of all samples, sorted; the class is the place, from 1; class 0 matches nothing
    start: np.ndarray  # of each state
    owner: np.ndarray
    target: np.ndarray
    roots: np.ndarray
    first: np.ndarray  # states after the first character, by language and class
    weights: np.ndarray  # logarithm of the training length

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(self.points):
            return np.zeros(len(points), np.uint32)
        spot = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(self.points[spot] == points, spot + 1, 0).astype(np.uint16 if len(self.points) < 1 << 16 else np.uint32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each coded text in each language."""
        blocks = [(i, codes[start : start + BLOCK]) for i, codes in enumerate(texts) for start in range(0, len(codes), BLOCK)]
        blocks.sort(key=lambda b: -len(b[1]))  # lanes that end early drop off at the end
        found = np.zeros((len(texts), len(self.languages)), np.int64)
        for start in range(0, len(blocks), _LANES):
            part = blocks[start : start + _LANES]
            counts = self._parse([b[1] for b in part])
            np.add.at(found, np.array([b[0] for b in part]), counts)
        return found

    def _parse(self, lanes: list[np.ndarray]) -> np.ndarray:
        lengths = np.array([len(lane) for lane in lanes])
        matrix = np.zeros((int(lengths[0]), len(lanes)), lanes[0].dtype)
        for i, lane in enumerate(lanes):
            matrix[: len(lane), i] = lane
        counts = np.zeros((len(self.languages), len(lanes)), np.int32)
        root = self.roots[:, None]
        state = np.repeat(root, len(lanes), axis=1)
        active = np.searchsorted(-lengths, -np.arange(len(matrix)), side="left")
        for j in range(len(matrix)):
            n = int(active[j])
            column = matrix[j, :n].astype(np.int32)
            now = state[:, :n]
            place = self.start[now] + column
            following = np.where(self.owner[place] == now, self.target[place], 0)
            fresh = (following == 0) | (now == root)  # a phrase begins here
            counts[:, :n] += fresh
            following = np.where(following == 0, self.first[:, column], following)
            state[:, :n] = np.where(following == 0, root, following)
        return counts.T

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language of each text, and how much better it fits than the next one, as a value from 0.5 to 1."""
        clean = [normalised(t) if t else "" for t in texts]
        letters = np.array([any(c.isalpha() for c in t) for t in clean], bool)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        counts = self.phrases([self.codes(t) if ok else np.zeros(0, np.uint16) for t, ok in zip(clean, letters)])
        cost = counts * self.weights
        order = np.argsort(cost, axis=1, kind="stable")
        rows = np.arange(len(texts))
        best = cost[rows, order[:, 0]]
        second = cost[rows, order[:, min(1, len(self.languages) - 1)]]
        score = np.where(letters, second / np.maximum(best + second, 1e-9), 0.0) if len(self.languages) > 1 else letters * 1.0
        return [self.languages[k] if ok else UNDETERMINED for k, ok in zip(order[:, 0], letters)], score


def train_model(samples: dict[str, str]) -> LanguageModel:
    """Automata from one normalised text per language."""
    languages = sorted(samples)
    points = np.unique(np.frombuffer("".join(samples.values()).encode("utf-32-le", "surrogatepass"), np.uint32))
    none = np.zeros(0, np.int32)
    model = LanguageModel(languages, points, none, none, none, none, np.zeros((len(languages), len(points) + 1), np.int32), np.zeros(0))
    starts, owners, targets, roots = [np.zeros(1, np.int64)], [none], [none], []  # state 0 stays unused
    states = places = 0
    for k, language in enumerate(languages):
        steps = suffix_automaton(model.codes(samples[language]).tolist())
        start, owner, target = packed_rows(steps, len(points) + 1)
        base = states + 1
        starts.append(start + places)
        owners.append(np.where(owner < 0, -1, owner + base).astype(np.int32))
        targets.append(target + np.int32(base))
        roots.append(base)
        for code, state in steps[0].items():
            model.first[k, code] = base + state
        states, places = states + len(steps), places + len(owner)
    model.start, model.owner, model.target = np.concatenate(starts).astype(np.int32), np.concatenate(owners), np.concatenate(targets)
    model.roots = np.array(roots, np.int32)
    model.weights = np.array([np.log2(max(FLOOR_CHARS, len(samples[k]))) for k in languages])
    return model


def training_samples(docs: DataFrame, learn: Column, chars: int = TRAIN_CHARS, rows: int = TRAIN_ROWS) -> dict[str, str]:
    """Per language about `chars` characters: equal stretches, from a hashed place on, of about `rows` labelled texts drawn by a hash of the id.

    Every label is learned. Labels are counted first, so each language's share of kept rows and the length of a stretch
    are known, no task ranks all rows, and the driver gets at most four times `chars` a language.
    """
    known = own_columns(docs.where(learn), {"doc_id": "doc_id", "text": "text", "lang": "lang"}).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return {}
    plan = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, rows / r["count"]), -(-4 * chars // min(rows, r["count"]))) for r in counts], "lang string, share double, stretch int"
    )
    spot = F.pmod(F.xxhash64(F.lit(_SEED), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    picked = known.join(F.broadcast(plan), "lang").where(spot < F.col("share"))  # one row per label
    room = F.greatest(F.length("text") - F.col("stretch"), F.lit(0)) + 1
    begin = (F.pmod(F.xxhash64(F.lit(_SEED + 1), "doc_id"), room) + 1).cast("int")
    picked = picked.select("lang", "doc_id", F.substring("text", begin, F.col("stretch")).alias("text"))
    texts: dict[str, list[tuple]] = {}
    for row in picked.toLocalIterator():
        texts.setdefault(row["lang"], []).append((spot_of(row["doc_id"]), row["text"]))
    samples = {}
    for language, found in texts.items():
        stretches = [normalised(t) for _, t in sorted(found)]
        text = " ".join(t[: stretch_of([len(t) for t in stretches], chars)] for t in stretches)[:chars]
        if any(c.isalpha() for c in text):
            samples[language] = text
    return samples


def stretch_of(lengths: list[int], chars: int) -> int:
    """The length to which texts are cut so that they have `chars` characters together; what short ones lack goes to the others."""
    left, count = chars, len(lengths)
    for length in sorted(lengths):
        if length * count >= left:
            return -(-left // count)
        left, count = left - length, count - 1
    return max(lengths, default=0)


def spot_of(doc_id: int) -> int:
    """Order of the sampled texts, unrelated to the order of the ids."""
    return (doc_id or 0) * 0x9E3779B1 % (1 << 32)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """uid, doc_id, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # TRAIN_CHARS a label

    def predicted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, score = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(languages, pa.string()), pa.array(score, pa.float64())],
                names=["uid", "doc_id", "lang_pred", "score"],
            )
            release()

    rows = own_columns(docs, {"doc_id": "doc_id", "text": "text"})
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(predicted, "uid bigint, doc_id bigint, lang_pred string, score double")
