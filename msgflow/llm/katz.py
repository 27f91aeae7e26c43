"""Katz backoff language model over words.

Tokens are words plus one end per text. Counts of n-grams of the training texts, up to the model's order, are
discounted by Good-Turing: with numbers of n-grams per count fitted by n_r ~ r^b (the linear
form), a count r is worth r (1 + 1/r)^(b + 1). The mass that leaves is spread over words not
seen after a history in proportion to their probability after the shorter one, with weights that make every
history sum to one; unigrams leave theirs to one class of unknown words. A token is scored recursively: by the
n-gram with its longest history if that was seen, else by the weight of that history times the score with a history
one word shorter, at last by its unigram or as unknown. A text starts with one mark, so the histories of its first tokens are shorter.

How the work is split: texts are turned once into chunks of about `CHUNK_TOKENS` tokens (a table
with the chunk's distinct words and its tokens as places in that list). Every chunk asks for the
counts of its distinct n-grams, in blocks by a hash of the key; for each slice of the hash
space (`bucket`) one task adds up the counts, so the count tables are partitioned by bucket, and
answers go back to the chunks. A key that occurs everywhere costs one entry per chunk. Weights of
histories are sums over owned n-grams, each owned by the first chunk that asked for it, and are
joined to the tokens that back off. Keys are 64-bit hashes of words and n-grams.

Results for odd input: null and empty text is the end token alone; repeated rows are scored and
counted like others; texts whose `learn` is null are scored but not learned from; without any training text
all tokens are unknown with probability one; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from msgflow.llm.common import bounds, own_columns, release, spans_of, whole_groups
from msgflow.session import stage

CHUNK_TOKENS = 1_000_000
SPECTRUM = 40  # counts r = 1 .. SPECTRUM whose numbers of n-grams are fitted
ORDER = 2  # tokens of the longest n-grams
_PART_BITS = 33
_END = np.uint64(xxh64_intdigest(b" "))  # no word holds a space
_START = np.uint64(xxh64_intdigest(b"  "))

_CHUNKS = "chunk bigint, uids binary, doc_ids array<bigint>, learned binary, lengths binary, words binary, tokens binary"
_ASKED = "bucket bigint, kind bigint, chunk bigint, keys binary, counts binary"
_ANSWERED = "chunk bigint, kind bigint, bucket bigint, totals binary, owned binary, spectrum array<bigint>, tokens bigint, types bigint"
_SCORED = (
    "kind int, uid bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double, "
    "level int, history bigint, times bigint, mass double, lower double"
)


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of an integer array: bytes of equal weight lie together."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every distinct word, place of each token in that list, and tokens per text, all texts ended by END."""
    folded = pc.ascii_lower(texts.cast(pa.large_string()).fill_null(""))
    split = pc.ascii_split_whitespace(folded)
    encoded = split.flatten().dictionary_encode()
    raw, starts = spans_of(encoded.dictionary)
    view = raw.tobytes()
    hashes = np.array([xxh64_intdigest(view[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())] + [int(_END)], np.uint64)
    place = encoded.indices.to_numpy().astype(np.int64)
    filled = (np.diff(starts) > 0)[place] if len(place) else np.zeros(0, bool)  # the split leaves empty words at the ends
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    kept = np.concatenate([[0], np.cumsum(filled)])[offsets]
    return hashes, np.insert(place[filled], kept[1:], len(hashes) - 1), np.diff(kept) + 1


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = None, 0
    held: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        nonlocal number
        words, places = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        edge = np.cumsum([0] + [len(h[0]) for h in held])
        tokens = np.concatenate([places[a:b][h[1]] for h, a, b in zip(held, edge[:-1], edge[1:])]).astype(np.uint32)
        row = {
            "chunk": (part << _PART_BITS) + number, "uids": np.concatenate([h[3] for h in held]).tobytes(),
            "doc_ids": [i for h in held for i in h[4]], "learned": np.concatenate([h[5] for h in held]).tobytes(),
            "lengths": np.concatenate([h[2] for h in held]).astype(np.int64).tobytes(), "words": pack_sorted(words), "tokens": pack(tokens),
        }
        number += 1
        return pa.RecordBatch.from_pylist([row], schema=pa.schema([
            ("chunk", pa.int64()), ("uids", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("learned", pa.binary()),
            ("lengths", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary()),
        ]))

    for batch in batches:
        if batch.num_rows == 0:
            continue
        uids = batch.column(0).to_numpy()
        part = int(uids[0]) >> _PART_BITS if part is None else part
        hashes, tokens, lengths = _tokens(batch.column(3))
        used, tokens = np.unique(tokens, return_inverse=True)
        held.append((hashes[used], tokens, lengths, uids, batch.column(1).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)))
        size += len(tokens)
        if size >= CHUNK_TOKENS:
            yield out()
            held, size = [], 0
            release()
    if held:
        yield out()
    release()


@dataclass
class Grams:
    """The distinct n-grams of one length in a chunk, in order of their hashes."""

    hashes: np.ndarray
    of_token: np.ndarray  # place of the n-gram that ends at each token; -1 where the text has too few words before it
    history: np.ndarray  # place of each n-gram's first words among those of the length below; for bigrams len(words) is the start
    shorter: np.ndarray  # place of each n-gram's last words among those of the length below


@dataclass
class Chunk:
    """A chunk's texts as n-grams; `grams[0]` are the words themselves."""

    words: np.ndarray
    tokens: np.ndarray
    learned: np.ndarray  # per token
    lengths: np.ndarray
    grams: list[Grams]

    @classmethod
    def read(cls, row: dict, order: int) -> Chunk:
        words = unpack_sorted(row["words"])
        tokens = unpack(row["tokens"], np.uint32).astype(np.int64)
        lengths = np.frombuffer(row["lengths"], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        learned = np.repeat(np.frombuffer(row["learned"], bool), lengths)
        none = np.zeros(0, np.int64)
        grams = [Grams(words, tokens, none, none)]
        for size in range(2, order + 1):
            below = grams[-1]
            before = np.concatenate([[0], below.of_token[:-1]])
            before[starts] = len(words) if size == 2 else -1
            whole = np.flatnonzero(before >= 0)
            codes, of_whole = np.unique(before[whole] * (len(words) + 1) + tokens[whole], return_inverse=True)
            history, word = np.divmod(codes, len(words) + 1)
            hashes = pair_hash((np.append(words, _START) if size == 2 else below.hashes)[history], words[word])
            order_of = np.argsort(hashes, kind="stable")
            place = np.empty_like(order_of)
            place[order_of] = np.arange(len(order_of))
            of_token = place[of_whole] if len(whole) == len(tokens) else np.full(len(tokens), -1, np.int64)
            if len(whole) != len(tokens):
                of_token[whole] = place[of_whole]
            shorter = np.zeros(len(codes), np.int64)
            shorter[of_token[whole]] = below.of_token[whole]
            grams.append(Grams(hashes[order_of], of_token, history[order_of], shorter))
        return cls(words, tokens, learned, lengths, grams)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64-bit hash of two hashes, in order."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) ^ ((second << np.uint64(23) | second >> np.uint64(41)) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0x165667B19E3779F9)
    return mixed ^ mixed >> np.uint64(32)


def _asked(bits: int, order: int):
    """Blocks of keys and their counts in the training texts of a chunk, by the top bits of the key."""

    def asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk.read(row, order)
                rows = []
                for kind, grams in enumerate(chunk.grams, 1):
                    keys, places = grams.hashes, grams.of_token[chunk.learned]
                    counts = np.bincount(places[places >= 0], minlength=len(keys))
                    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
                    edge = bounds(bucket)
                    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                        rows.append((int(bucket[a]), kind, row["chunk"], pack_sorted(keys[a:b]), pack(counts[a:b].astype(np.uint32))))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in _ASKED.split(", ")])
                release()

    return asked


def _answered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Total counts for every block of a bucket, and which of its keys the block's chunk owns."""
    names = [f.split()[0] for f in _ANSWERED.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64())
    for rows in whole_groups(batches, "bucket", "kind"):
        bucket, kind, chunk = (rows.column(c).to_numpy() for c in ("bucket", "kind", "chunk"))
        edge = np.union1d(bounds(bucket), bounds(kind))
        data, counted = rows.column("keys"), rows.column("counts")
        out = []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            keys = [unpack_sorted(data[i].as_py()) for i in range(a, b)]
            counts = np.concatenate([unpack(counted[i].as_py(), np.uint32) for i in range(a, b)])
            distinct, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            totals = np.bincount(place, counts, len(distinct)).astype(np.int64)
            owned = np.zeros(len(place), bool)
            owned[first] = True  # the first block in order of chunks
            at = 0
            for i, own in zip(range(a, b), keys):
                mine = slice(at, at + len(own))
                at += len(own)
                found = totals[place[mine]]
                first_seen = found[owned[mine] & (found > 0)]
                spectrum = np.bincount(np.minimum(first_seen, SPECTRUM + 1), minlength=SPECTRUM + 2)[1 : SPECTRUM + 1]
                out.append((int(chunk[i]), int(kind[i]), int(bucket[i]), pack(found), np.packbits(owned[mine]).tobytes(),
                            spectrum.tolist(), int(first_seen.sum()), len(first_seen)))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
    release()


@dataclass(frozen=True)
class Discounts:
    """What the model knows as a whole."""

    slopes: tuple[float, ...]  # b of n_r ~ r^b for n-grams of each length
    tokens: int
    types: int
    texts: int
    unknown: float = 1.0  # probability of the class of unknown words

    def discounted(self, order: int, counts: np.ndarray) -> np.ndarray:
        return counts * (1.0 + 1.0 / np.maximum(counts, 1)) ** (self.slopes[order - 1] + 1.0)


def fitted_slope(spectrum: list[int]) -> float:
    """Slope of log n_r over log r by least squares, weighted by n_r; below -1, so that every count is discounted."""
    r = np.array([i + 1 for i, n in enumerate(spectrum) if n > 0], np.float64)
    n = np.array([n for n in spectrum if n > 0], np.float64)
    if len(r) < 2:
        return -2.0
    slope = np.polyfit(np.log(r), np.log(n), 1, w=np.sqrt(n))[0]
    return float(np.clip(slope, -4.0, -1.1))


def _scored(model: Discounts):
    names = [f.split()[0] for f in _SCORED.split(", ")]
    log10 = np.log10
    top = len(model.slopes)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = right.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        kinds = answers.column("kind").to_numpy()
        totals, owned = {}, {}
        for kind in range(1, top + 1):
            rows = np.flatnonzero(kinds == kind).tolist()
            found = [unpack(answers.column("totals")[i].as_py(), np.int64) for i in rows]
            bits = [np.unpackbits(np.frombuffer(answers.column("owned")[i].as_py(), np.uint8), count=len(t)).astype(bool) for i, t in zip(rows, found)]
            totals[kind] = np.concatenate(found) if found else np.zeros(0, np.int64)
            owned[kind] = np.concatenate(bits) if bits else np.zeros(0, bool)
        row = left.to_pylist()[0]
        chunk = Chunk.read(row, top)
        words = totals[1]
        starts = np.concatenate([[0], np.cumsum(chunk.lengths)])[:-1]
        n = len(starts)
        uids = np.frombuffer(row["uids"], np.int64)

        def filled(size: int, **values) -> dict:
            return {name: values.get(name, [None] * size) for name in names}

        tables = []
        with np.errstate(divide="ignore", invalid="ignore"):
            probability = np.where(words > 0, model.discounted(1, words) / max(1, model.tokens), model.unknown)  # of every n-gram seen, after its history
            score = log10(probability)[chunk.tokens]  # with histories of up to so many words
        histories, hashes = np.append(words, model.texts), np.append(chunk.words, _START).view(np.int64)  # how often a word, or the start, came before another token
        # From short histories to long ones: a token not seen after a history keeps its score with the shorter one, times the history's weight.
        owner = np.repeat(np.arange(n), chunk.lengths)
        waiting: list[tuple[int, np.ndarray, np.ndarray]] = []  # level, tokens that back off, places of their histories
        for kind in range(2, top + 1):
            grams, counts = chunk.grams[kind - 1], totals[kind]
            with np.errstate(divide="ignore", invalid="ignore"):
                after = model.discounted(kind, counts) / histories[grams.history]
                seen = log10(after)
            whole = grams.of_token >= 0
            found = whole.copy()
            found[whole] = counts[grams.of_token[whole]] > 0
            score = np.where(found, seen[grams.of_token], score) if len(seen) else score
            waiting = [(level, *(x[~found[tokens]] for x in (tokens, places))) for level, tokens, places in waiting]  # a token seen here backs off no more
            back = np.flatnonzero(whole & ~found)
            places = grams.history[grams.of_token[back]]
            known = histories[places] > 0
            waiting.append((kind, back[known], places[known]))

            # Sums over the n-grams that this chunk owns, for the weights of their histories.
            own = owned[kind] & (counts > 0)
            places = grams.history[own]
            mass = np.bincount(places, after[own], len(hashes))
            below = np.bincount(places, probability[grams.shorter[own]], len(hashes))
            used = np.unique(places)
            tables.append(filled(len(used), kind=[1] * len(used), level=[kind] * len(used), history=hashes[used], mass=mass[used], lower=below[used]))

            # Tokens that back off, by text and history; those of shorter histories that turn out not to are taken back below.
            waiting[-1] = (*waiting[-1][:2], hashes[waiting[-1][2]])
            probability, histories, hashes = after, counts, grams.hashes.view(np.int64)
        for level, tokens, keys in waiting:
            distinct, places = np.unique(keys, return_inverse=True)
            codes, times = np.unique(owner[tokens] * max(1, len(distinct)) + places, return_counts=True)
            text, place = np.divmod(codes, max(1, len(distinct)))
            tables.append(filled(len(codes), kind=[2] * len(codes), level=[level] * len(codes), uid=uids[text], history=distinct[place], times=times))

        base = log10((words + 1) / (model.tokens + model.types + 1))[chunk.tokens]
        sums = [np.add.reduceat(v, starts) for v in (words[chunk.tokens] > 0, base, score)] if n else [np.zeros(0)] * 3
        tables.append(filled(n, kind=[0] * n, uid=uids, doc_id=row["doc_ids"], n_tokens=chunk.lengths, n_known=sums[0].astype(np.int64), base_score=sums[1], score=sums[2]))
        schema = pa.schema([(f.split()[0], {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}[f.split()[1]]) for f in _SCORED.split(", ")])
        result = pa.concat_tables([pa.table({k: pa.array(v, schema.field(k).type) for k, v in t.items()}, schema=schema) for t in tables])
        release()
        return result

    return scored


def _discounted_mass(model: Discounts):
    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            for data, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = unpack(data, np.int64)
                own = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(counts)).astype(bool) & (counts > 0)
                total += float(model.discounted(1, counts[own]).sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["mass"])

    return summed


def score_texts(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None, order: int = ORDER
) -> DataFrame:
    """Every text scored by the model of the texts for which `learn` holds, with n-grams of up to `order` tokens.

    uid, doc_id, n_tokens, n_known, train_tokens, base_score (add-one unigrams) and score
    (log10 probability). `buckets`, a power of two, is the number of slices of the count tables;
    unset, it follows the number of chunks. It does not change results.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(learn, F.lit(False)).alias("learned"), F.col(f"`{text_col}`").alias("text"),
    )
    chunks = stage(rows.mapInArrow(_chunks, _CHUNKS), "chunks")
    number = chunks.count()
    bits = max(4, math.ceil(math.log2(buckets or max(64, min(8192, 2 * number)))))
    asked = chunks.mapInArrow(_asked(bits, order), _ASKED)
    asked = asked.repartition("bucket").sortWithinPartitions("bucket", "kind", "chunk")
    answered = stage(asked.mapInArrow(_answered, _ANSWERED), "counts")

    numbers = {r["kind"]: r for r in answered.groupBy("kind").agg(
        F.sum("tokens").alias("tokens"), F.sum("types").alias("types"), *[F.sum(F.col("spectrum")[i]).alias(f"n{i}") for i in range(SPECTRUM)]
    ).collect()}
    slopes = tuple(fitted_slope([numbers[k][f"n{i}"] for i in range(SPECTRUM)]) if k in numbers else -2.0 for k in range(1, order + 1))
    texts = rows.where("learned").count()
    model = Discounts(slopes, numbers[1]["tokens"] if 1 in numbers else 0, numbers[1]["types"] if 1 in numbers else 0, texts)
    if model.tokens:
        kept = answered.where("kind = 1").select("totals", "owned").mapInArrow(_discounted_mass(model), "mass double").agg(F.sum("mass")).first()[0]
        model = Discounts(slopes, model.tokens, model.types, texts, 1.0 - kept / model.tokens)

    scored = chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(_scored(model), _SCORED)
    scored = stage(scored, "scored")
    weights = scored.where("kind = 1").groupBy("level", "history").agg(F.sum("mass").alias("mass"), F.sum("lower").alias("lower"))
    weights = weights.select("level", "history", F.log10((1 - F.col("mass")) / (1 - F.col("lower"))).alias("weight"))
    backed = scored.where("kind = 2").select("uid", "level", "history", "times").join(weights, ["level", "history"])
    added = backed.groupBy("uid").agg(F.sum(F.col("times") * F.col("weight")).alias("added"))
    return scored.where("kind = 0").select("uid", "doc_id", "n_tokens", "n_known", "base_score", "score").join(added, "uid", "left").select(
        "uid", "doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score",
        (F.col("score") + F.coalesce("added", F.lit(0.0))).alias("score"),
    )
