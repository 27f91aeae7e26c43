"""SimHash near-duplicates by segment popcounts.

A fingerprint is mapped to the number of bits set in each of its 32 two-bit segments. The
Manhattan distance of two such vectors never exceeds the number of differing bits, so links
(two or fewer bits) lie within Manhattan distance two. The grid join finds those: each
vector is written to its own grid point and to all points one step away, and two vectors
within distance two meet in at least one point. Candidates that meet are verified on the
fingerprints. Points where more than `CROWD` fingerprints meet are not compared pair by pair:
those fingerprints go to the finest grid (64 one-bit segments, where the bound is exact) and
are linked to the smallest one at each of its points. So every link is found, no pair is
enumerated in a crowd, and documents with one fingerprint are one node.

Results for odd input: null or empty text and text without words has fingerprint zero and is
linked like any other; repeated rows share a fingerprint; null ids take part but never name a
component (a component of null ids only has a null name); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from msgflow.llm.common import bounds, bytes_of, own_columns, release
from msgflow.llm.components import components
from msgflow.session import stage

SHINGLE = 3
SEED = 42
MAX_BITS = 2
CROWD = 64  # fingerprints at a grid point that are compared pair by pair
_PIECE = 1 << 16  # shingles hashed at once: long texts need no more memory than that
_ODD = np.uint64(0x5555555555555555)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, all with equal weight, repeats included."""
    words = text.lower().split()  # A-Z folded; split at space and bytes 9 to 13
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    set_bits = np.zeros(64, np.int64)
    for start in range(0, n, _PIECE):
        part = words[start : start + _PIECE + shingle - 1]
        if len(words) < shingle:
            joined = [b" ".join(words)]
        else:
            joined = map(b" ".join, zip(*[part[i:] for i in range(shingle)]))
        hashes = np.array([xxh64_intdigest(s, SEED) for s in joined], np.uint64)
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(text) for text in bytes_of(batch.column(2))], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["uid", "doc_id", "fp"])
        release()


def fingerprint_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", uid_col: str | None = None) -> DataFrame:
    """uid (taken from `uid_col`, where rows have a number), doc_id and fp (the 64 bits as a long) of every document."""
    rows = own_columns(docs, {"doc_id": id_col, "text": text_col} | ({"uid": uid_col} if uid_col else {}))
    uid = F.col("uid") if uid_col else F.monotonically_increasing_id().alias("uid")
    rows = rows.select(uid, F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(_fingerprints, "uid bigint, doc_id bigint, fp bigint")


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """Bits set in each two-bit segment, packed two bits per segment like the fingerprint."""
    half = fp >> np.uint64(1)
    return ((fp & half & _ODD) << np.uint64(1)) | ((fp ^ half) & _ODD)


def _grid_points(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint at its own point of the segment grid and at all points one step away."""
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for start in range(0, len(fp), 20_000):
            part = fp[start : start + 20_000]
            own = segment_counts(part)
            points, owners = [own], [part]
            for segment in range(32):
                shift = np.uint64(2 * segment)
                count = (own >> shift) & np.uint64(3)
                near_zero, near_two = count < 2, count > 0  # 0 <-> 1 flips the low bit, 1 <-> 2 flips both
                points += [own[near_zero] ^ (np.uint64(1) << shift), own[near_two] ^ (np.uint64(3) << shift)]
                owners += [part[near_zero], part[near_two]]
            yield _longs(point=np.concatenate(points), fp=np.concatenate(owners))


def _bit_points(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint at its own point of the one-bit grid and at all points one step away."""
    flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for start in range(0, len(fp), 20_000):
            part = fp[start : start + 20_000]
            yield _longs(point=(part[:, None] ^ flips).ravel(), fp=np.repeat(part, 65))


def _longs(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns.values()], names=list(columns))


def _meetings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links among the fingerprints of each point; those of a crowded point with a null partner.

    The rows of a point come together. Memory: a batch and at most `CROWD` rows.
    """
    held = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    crowded = None  # point whose rows so far were handed on

    def compared(point: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        nonlocal crowded
        edge = bounds(point)
        size = np.repeat(np.diff(edge), np.diff(edge))
        crowd = size > CROWD
        if crowded is not None:
            crowd |= point == crowded
        if crowd.any():
            yield pa.RecordBatch.from_arrays([pa.array(fp[crowd].view(np.int64)), pa.nulls(int(crowd.sum()), pa.int64())], names=["a", "b"])
            crowded = point[crowd][-1]
        point, fp = point[~crowd], fp[~crowd]
        for step in range(1, CROWD):
            if len(point) <= step:
                break
            same = point[step:] == point[:-step]
            if not same.any():
                break
            left, right = fp[:-step][same], fp[step:][same]
            linked = (np.bitwise_count(left ^ right) <= MAX_BITS) & (left != right)
            if linked.any():
                yield _longs(a=left[linked], b=right[linked])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        point = np.concatenate([held[0], batch.column(0).to_numpy().view(np.uint64)])
        fp = np.concatenate([held[1], batch.column(1).to_numpy().view(np.uint64)])
        start = int(np.flatnonzero(point == point[-1])[0])
        if len(point) - start > CROWD:  # already a crowd: hand on, and remember the point
            yield from compared(point, fp)
            held = point[:0], fp[:0]
        else:
            yield from compared(point[:start], fp[:start])
            held = point[start:], fp[start:]
    yield from compared(*held)


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links every fingerprint at a one-bit point to the first one there; both lie within two bits."""
    last_point = last_fp = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        point, fp = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        edge = bounds(point)
        first = np.repeat(fp[edge[:-1]], np.diff(edge))
        if last_point is not None and point[0] == last_point:
            first[: edge[1]] = last_fp
        last_point, last_fp = point[-1], first[-1]
        other = fp != first
        yield _longs(a=fp[other], b=first[other])


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column fp) that keep all components of the relation "two or fewer bits differ"."""
    met = distinct.select("fp").mapInArrow(_grid_points, "point bigint, fp bigint")
    met = met.repartition("point").sortWithinPartitions("point", "fp").mapInArrow(_meetings, "a bigint, b bigint")
    met = stage(met.distinct(), "meetings")
    crowd = met.where("b IS NULL").select(F.col("a").alias("fp"))
    finest = crowd.mapInArrow(_bit_points, "point bigint, fp bigint")
    stars = finest.repartition("point").sortWithinPartitions("point", "fp").mapInArrow(_stars, "a bigint, b bigint")
    return met.where("b IS NOT NULL").unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", uid_col: str | None = None) -> DataFrame:
    """Every document with its fingerprint and the smallest id reachable by links: uid, doc_id, fp, component_id, keep_uid.

    `keep_uid` is the row to keep for the component: the first row of the smallest id.
    """
    rows = stage(fingerprint_rows(docs, id_col, text_col, uid_col), "fingerprints")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "uid")).alias("least")
    distinct = stage(rows.groupBy("fp").agg(smallest), "distinct")
    roots = components(fingerprint_links(distinct))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    lowest = named.groupBy("root").agg(F.min("least").alias("lowest"))
    classes = named.join(lowest, "root").select("fp", F.col("lowest.doc_id").alias("component_id"), F.col("lowest.uid").alias("keep_uid"))
    return rows.join(classes, "fp").select("uid", "doc_id", "fp", "component_id", "keep_uid")
