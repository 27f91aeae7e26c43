"""What the operators share: session settings, whole key groups from sorted streams, bounded samples, byte-wise folding."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.session import configure

# Rows and bytes of one Arrow batch: documents are long, so batches are kept small.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators."""
    configure(spark)
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number: the fold of a document."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def release() -> None:
    """Give freed memory back to the system: Python workers are reused and would keep their peak."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no such call on this platform
        pass


def own_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the named columns, under fixed names, so that further columns cannot clash.

    `columns` maps the fixed name to the column of `df`.
    """
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def whole_groups(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Tables that hold only whole groups, from a stream sorted by long columns.

    The last group of a batch waits for the next one. Memory: a batch and one group.
    """
    waiting: list[pa.Table] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch])
        values = [rows.column(key).to_numpy() for key in keys]
        first, final = tuple(v[0] for v in values), tuple(v[-1] for v in values)
        if first == final == last:
            waiting.append(rows)
            continue
        start = max(int(bounds(v)[-2]) for v in values)
        ready = pa.concat_tables([*waiting, rows.slice(0, start)])
        if ready.num_rows:
            yield ready.combine_chunks()
        waiting, last = [rows.slice(start)], final
    if waiting:
        yield pa.concat_tables(waiting).combine_chunks()


def bounds(keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal keys, and the end."""
    if len(keys) == 0:
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def bounded_sample(rows: DataFrame, key: str, limit: int, seed: int) -> DataFrame:
    """About `limit` rows at most, chosen by a hash of the key, the same ones on every attempt.

    The share that is kept follows from a count, so no task ranks all rows. The
    expected size is `limit`; it is exact (all rows) when there are no more rows than that.
    """
    total = rows.count()
    if total <= limit:
        return rows
    spot = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30))
    return rows.where(spot < int(limit / total * (1 << 30)))


def spans_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    elif pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, starts


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null is empty."""
    raw, starts = spans_of(column)
    view = raw.tobytes()
    return [view[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]


def kept_rows(docs: DataFrame, good) -> DataFrame:
    """Rows of `docs` whose text is judged good: `good` maps a text column to a list of booleans. No join, no shuffle."""
    place = docs.columns.index("text")

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(good(batch.column(place)), pa.bool_()))
            release()

    return docs.mapInArrow(kept, docs.schema)
