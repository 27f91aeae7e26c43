"""Near-duplicate vectors by randomised-rotation binary codes.

Vectors are turned to unit length, embedded in `CODE_BITS` dimensions by a random matrix with
orthonormal columns, and coded by the signs. The code is stored once per distinct vector, with the correction
factor that makes the inner product of a code and a vector an unbiased estimate of that of the two vectors.
Vectors of one label whose codes agree in a band of bits meet.

Meetings see codes only. Two vectors at the threshold differ in a known share of the signs; pairs that differ in
more than that and its confidence bound are settled there. Vectors are fetched for those that are left with an
undecided partner, and only to the meeting where it is. There the estimate from the stored code and
factor, plus its bound, decides which pairs are recomputed exactly, in double precision; nothing is linked by an estimate.

Equal vectors of a label are one row with a count. Most (vector, band) rows meet no other one and are dropped
while they are only numbers. Large buckets are cut into blocks, and pairs of blocks go to different tasks;
pairs are compared inside a task: what leaves it are the vectors that need a closer look, then counts
and a spanning forest of links. A pair that meets in several bands is counted in the first one.

`recall` of the bands at the threshold is 1 - (1 - p^20)^25 with p = 1 - acos(0.98) / pi: above 0.999 there and higher for
closer pairs; each of the two bounds is four standard deviations wide.

Results for odd input: vectors that are null, empty, zero or hold null or non-finite values, and
those without a label, link with nothing; vectors of different lengths link with nothing; repeated
rows link with each other; a null id takes part but never names a component; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import bounds, own_columns, release, whole_groups
from msgflow.llm.components import components
from msgflow.session import stage

THRESHOLD = 0.98
BANDS, BAND_BITS = 25, 20
CODE_BITS = 512
CONFIDENCE = 4.0  # standard deviations of the estimate
BLOCK = 512  # vectors of a bucket that meet in one task, per side
_SEED = 5

_CODED = "uid bigint, vec_id bigint, kind string, digest binary, vector binary, size int, bands array<int>, code binary, factor double"
_BUCKET = ["kind", "size", "band", "key"]


@lru_cache(maxsize=4)
def rotation(size: int, seed: int = _SEED) -> np.ndarray:
    """`size` x max(CODE_BITS, size) matrix: the first rows of a random orthogonal matrix."""
    wide = max(CODE_BITS, size)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((wide, size)))
    return (q * np.sign(np.diag(r))).T


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs of the rotated vectors, and the inner product of each rotated vector with its own code."""
    rotated = unit @ rotation(unit.shape[1])
    signs = rotated >= 0
    factor = np.abs(rotated).sum(axis=1) / np.sqrt(rotated.shape[1])
    return signs, factor


def estimates(signs: np.ndarray, factor: np.ndarray, unit: np.ndarray, confidence: float = CONFIDENCE) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the inner products of coded vectors (rows) and plain ones (columns), and the bound of their error."""
    wide = signs.shape[1]
    codes = (signs * np.float32(2) - np.float32(1)) / np.float32(np.sqrt(wide))
    rotated = (unit @ rotation(unit.shape[1])).astype(np.float32)
    estimate = (codes @ rotated.T) / factor[:, None].astype(np.float32)
    error = confidence * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / (wide - 1))
    return estimate, error[:, None]


def band_keys(signs: np.ndarray) -> np.ndarray:
    """One integer per band of bits."""
    used = signs[:, : BANDS * BAND_BITS].reshape(len(signs), BANDS, BAND_BITS)
    return (used * (1 << np.arange(BAND_BITS))).sum(axis=2).astype(np.int32)


def packed_signs(signs: np.ndarray) -> np.ndarray:
    """Signs as 64-bit words, one row per code."""
    wide = -signs.shape[1] % 64
    return np.packbits(np.pad(signs, ((0, 0), (0, wide))), axis=1).view(np.uint64)


def unpacked_signs(codes: list[bytes], size: int) -> np.ndarray:
    """Signs of stored codes of vectors of `size` components."""
    packed = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    return np.unpackbits(packed, axis=1)[:, : max(CODE_BITS, size)].astype(bool)


def most_differing(bits: int, threshold: float = THRESHOLD, confidence: float = CONFIDENCE) -> int:
    """Signs in which two vectors at the threshold may differ, with the confidence bound: a sign differs with the probability angle / pi."""
    share = np.arccos(threshold) / np.pi
    return int(np.ceil(bits * share + confidence * np.sqrt(bits * share * (1 - share))))


def _coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column(3).to_pylist()
        labels = batch.column(2).to_pylist()
        vectors: list[np.ndarray | None] = []
        for vector, label in zip(rows, labels):
            values = None
            if label is not None and vector and None not in vector:
                values = np.array(vector, np.float64)
                if not (np.isfinite(values).all() and values.any()):
                    values = None
            vectors.append(values)
        bands: list = [None] * len(vectors)
        codes, factors = list(bands), list(bands)
        for size in {len(v) for v in vectors if v is not None}:
            places = [i for i, v in enumerate(vectors) if v is not None and len(v) == size]
            unit = _unit(np.stack([vectors[i] for i in places]))
            signs, factor = encode(unit)
            for i, keys, code, own in zip(places, band_keys(signs), packed_signs(signs), factor.tolist()):
                bands[i], codes[i], factors[i] = keys, code.tobytes(), own
        packed = [None if v is None else (v + 0.0).tobytes() for v in vectors]
        kinds = [None if p is None else str(label) for p, label in zip(packed, labels)]
        digests = [None if p is None else hashlib.sha256(kind.encode() + b"\0" + p).digest() for p, kind in zip(packed, kinds)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(kinds, pa.string()), pa.array(digests, pa.binary()), pa.array(packed, pa.binary()),
             pa.array([None if v is None else len(v) for v in vectors], pa.int32()), pa.array(bands, pa.list_(pa.int32())),
             pa.array(codes, pa.binary()), pa.array(factors, pa.float64())],
            names=["uid", "vec_id", "kind", "digest", "vector", "size", "bands", "code", "factor"],
        )
        release()


def _unit(values: np.ndarray) -> np.ndarray:
    scaled = values / np.abs(values).max(axis=1, keepdims=True)  # no overflow for very large values
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


_MEETING = ["meeting", "size", "band", "key", "i", "j"]


def _meetings(rows: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row of each meeting, and the rows of its two sides, by place in the meeting.

    A meeting's number is a hash: rows of two meetings that share it are told apart by what they hold.
    """
    edge = np.unique(np.concatenate([bounds(rows.column(c).to_numpy()) for c in _MEETING]))
    side, alone = rows.column("side").to_numpy(), rows.column("alone").to_numpy()
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        left = np.flatnonzero(side[a:b] == 0)
        right = left if alone[a] else np.flatnonzero(side[a:b] == 1)
        if len(left) and len(right):
            yield a, b, left, right


def _pairs(maybe: np.ndarray, left: np.ndarray, right: np.ndarray, alone: bool, signs: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs marked in `maybe` that meet here first: in no earlier band do their codes agree."""
    i, j = np.nonzero(np.triu(maybe | maybe.T, 1) if alone else maybe)
    i, j = left[i], right[j]
    keys = band_keys(signs)
    first = np.zeros(len(i), bool)
    for start in range(0, len(i), 1 << 18):
        part = slice(start, start + (1 << 18))
        first[part] = np.argmax(keys[i[part]] == keys[j[part]], axis=1) == band
    return i[first], j[first]


def _undecided(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of vectors that have a partner in their meeting which their codes leave undecided."""
    for rows in whole_groups(batches, "meeting"):
        codes, sizes = rows.column("code"), rows.column("size").to_numpy()
        band, alone = rows.column("band").to_numpy(), rows.column("alone").to_numpy()
        needed = np.zeros(rows.num_rows, bool)
        for a, b, left, right in _meetings(rows):
            signs = unpacked_signs(codes.slice(a, b - a).to_pylist(), int(sizes[a]))
            packed = packed_signs(signs)
            differing = np.zeros((len(left), len(right)), np.int32)
            for word in range(packed.shape[1]):
                differing += np.bitwise_count(packed[left, word][:, None] ^ packed[right, word])
            i, j = _pairs(differing <= most_differing(signs.shape[1]), left, right, bool(alone[a]), signs, int(band[a]))
            needed[a + i] = needed[a + j] = True
        if needed.any():
            yield from rows.drop_columns(["code"]).filter(pa.array(needed)).to_batches()
    release()


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each meeting of two blocks (or of a block with itself): counts per vector and a spanning forest."""
    for rows in whole_groups(batches, "meeting"):
        rep, copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
        band, alone, factors = (rows.column(c).to_numpy() for c in ("band", "alone", "factor"))
        raw, codes, sizes = rows.column("vector").combine_chunks(), rows.column("code"), rows.column("size").to_numpy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a, b, left, right in _meetings(rows):
            values = np.frombuffer(b"".join(raw.slice(a, b - a).to_pylist()), np.float64).reshape(b - a, -1)
            signs = unpacked_signs(codes.slice(a, b - a).to_pylist(), int(sizes[a]))
            estimate, error = estimates(signs[left], factors[a:b][left], _unit(values)[right])
            i, j = _pairs(estimate + error >= THRESHOLD, left, right, bool(alone[a]), signs, int(band[a]))
            norm = np.linalg.norm(values, axis=1)
            exact = np.einsum("ij,ij->i", values[i], values[j]) / (norm[i] * norm[j])
            close = exact >= THRESHOLD
            i, j = i[close], j[close]
            if not len(i):
                continue
            links = np.bincount(i, copies[a:b][j], b - a) + np.bincount(j, copies[a:b][i], b - a)
            linked = np.flatnonzero(links)
            root = _forest(i, j, b - a)
            found.append((rep[a:b][linked], links[linked].astype(np.int64), rep[a:b][root[linked]]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["rep", "links", "root"])
    release()


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """A node of the component of each of n nodes, the same one for all of it."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Every vector with the number of vectors it links with, its component and whether it names it: vec_id, n_links, component_id, kept."""
    rows = own_columns(vectors, {"vec_id": id_col, "label": label_col, "vector": vector_col})
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("bigint"), "label", F.col("vector").cast("array<double>"))
    coded = stage(rows.mapInArrow(_coded, _CODED), "vectors")

    # One row per distinct vector of a label; its uid stands for it.
    distinct = coded.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("uid", "kind", "size", "vector", "bands", "code", "factor")).alias("one"),
        F.count("*").alias("copies"),
        F.min("vec_id").alias("least"),
    )
    distinct = stage(distinct.select("digest", "copies", "least", F.col("one.uid").alias("rep"), "one.kind", "one.size", "one.vector", "one.bands", "one.code", "one.factor"), "distinct")

    members = distinct.select("rep", "kind", "size", F.posexplode("bands").alias("band", "key"))
    shared = members.groupBy(*_BUCKET).count().where("count > 1").withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count")
    members = members.join(shared, _BUCKET).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # Every block meets every block of its bucket, itself included, in one place.
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meetings = members.select(
        "rep", "size", "band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), (F.col("own") == F.col("other")).alias("alone"),
        F.xxhash64(*_BUCKET, F.least("own", "other"), F.greatest("own", "other")).alias("meeting"),
    )
    order = [*_MEETING, "rep"]
    kept = "rep bigint, size int, band int, key int, i int, j int, side int, alone boolean, meeting bigint"
    screened = meetings.join(distinct.select("rep", "code"), "rep").repartition("meeting").sortWithinPartitions(*order)
    screened = stage(screened.mapInArrow(_undecided, kept), "undecided")
    filled = screened.join(distinct.select("rep", "copies", "code", "factor", "vector"), "rep")
    compared = filled.repartition("meeting").sortWithinPartitions(*order).mapInArrow(_compare, "rep bigint, links bigint, root bigint")
    compared = stage(compared, "compared")

    degrees = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(compared.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    named = distinct.select("rep", "digest", "copies", "least").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    classes = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").join(degrees, "rep", "left")
    classes = classes.select("digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return coded.select("vec_id", "digest").join(classes, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
