"""Exact deduplication: tree merge of sorted digest runs.

Every input partition yields one run of digests. Runs are merged in rounds: in each
round `fan` neighbouring runs meet, per slice of the digest space, and a merged run
keeps one row per digest with the identifier that stays and the number of copies. So no
task sees more than its slice of `fan` runs, and a text that a third of all rows share
costs one row per run. Decisions then go down the same tree, again one row per digest and run.

Results for odd input: a null text counts as empty; a null id sorts before all others;
equal rows, even with equal ids, count as copies and exactly one of them stays; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import bytes_of, own_columns, release
from msgflow.session import stage

FAN = 16  # runs that are merged at once
SLICES = 256  # slices of the digest space: tasks of the last round
_RUN_BITS = 33  # monotonically_increasing_id holds the partition above these bits
_TEXT = ["digest", "n_bytes", "mark"]  # equal for equal texts; the mark and the length verify the digest
_LEAF = "uid bigint, doc_id bigint, slice int, digest binary, n_bytes bigint, mark bigint"


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        folded = [text.lower() for text in bytes_of(batch.column(2))]  # bytes.lower folds A-Z only
        digests = [hashlib.sha256(text).digest() for text in folded]
        marks = np.fromiter((xxhash.xxh64_intdigest(text) for text in folded), np.uint64, len(folded)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array([(d[0] << 8 | d[1]) % SLICES for d in digests], pa.int32()),
                pa.array(digests, pa.binary()), pa.array([len(text) for text in folded], pa.int64()), pa.array(marks),
            ],
            names=["uid", "doc_id", "slice", "digest", "n_bytes", "mark"],
        )
        release()


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", uid_col: str | None = None) -> DataFrame:
    """One row per document: a row id that holds the run (partition) above 33 bits, the digest of the folded text, its length and a second hash.

    `uid_col` names a column of such row ids, where rows have them.
    """
    rows = own_columns(docs, {"doc_id": id_col, "text": text_col} | ({"uid": uid_col} if uid_col else {}))
    uid = F.col("uid") if uid_col else F.monotonically_increasing_id().alias("uid")
    rows = rows.select(uid, F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(_digest, _LEAF)


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", fan: int = FAN, uid_col: str | None = None,
) -> DataFrame:
    """Every document with the row that stays for its text.

    Texts are equal when identical after lower-casing A-Z. Returns uid, doc_id, digest,
    keep_id, keep_uid, group_size and kept; one row per input row.
    """
    pick = {"largest": F.max, "smallest": F.min}[keep]
    # Staged once: row ids and runs must not change between the way up and the way down.
    leaves = stage(digest_rows(docs, id_col, text_col, uid_col), "digests")
    leaves = leaves.withColumn("run", F.shiftright("uid", _RUN_BITS))
    runs = (leaves.agg(F.max("run")).first()[0] or 0) + 1

    def merged(rows: DataFrame, best, copies) -> DataFrame:
        # Sorted by digest within (slice, run): a sort-based merge of the runs that meet there.
        meet = rows.repartition("slice", "run").sortWithinPartitions("slice", "run", *_TEXT)
        return meet.groupBy("slice", "run", *_TEXT).agg(pick(best).alias("best"), F.sum(copies).alias("n"))

    levels = [stage(merged(leaves, F.struct("doc_id", "uid"), F.lit(1)), "runs")]
    while runs > 1:
        up = levels[-1].withColumn("run", F.floor(F.col("run") / fan).cast("bigint"))
        levels.append(stage(merged(up, F.col("best"), F.col("n")), "runs"))
        runs = -(-runs // fan)

    decided = levels.pop().where("n > 1").withColumnRenamed("run", "above")
    while levels:
        below = levels.pop().select("slice", "run", *_TEXT, F.floor(F.col("run") / fan).cast("bigint").alias("above"))
        decided = below.join(decided, ["slice", "above", *_TEXT]).drop("above").withColumnRenamed("run", "above")
    decided = decided.withColumnRenamed("above", "run")
    return leaves.join(decided, ["slice", "run", *_TEXT], "left").select(
        "uid", "doc_id", "digest",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("best.uid", "uid").alias("keep_uid"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (F.coalesce("best.uid", "uid") == F.col("uid")).alias("kept"),
    )
