"""Rows of a stored table by a number that no later read changes, and leaving out some of them.

A row's number is that of its file, by path, above 33 bits and its place in the file below. It does not depend on
how the files are split into tasks, so decisions made in one read hold in any other, whatever the cluster's size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import release
from msgflow.session import stage, work_path

FILE_BITS = 33


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a further column, whose name is returned, that holds the row's number.

    A table that does not come straight from files is written to the shared folder first. The
    list of files is broadcast: one path per file.
    """
    name = "row"
    while name in docs.columns:
        name += "_"
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = stage(docs, "rows")
    spark = docs.sparkSession
    rows = docs.select("*", F.col("_metadata.file_path").alias(f"{name}file"), F.col("_metadata.row_index").alias(f"{name}place"))
    paths = sorted(row[0] for row in rows.select(f"{name}file").distinct().collect())
    files = spark.createDataFrame(list(enumerate(paths)), f"{name} bigint, {name}file string")
    rows = rows.join(F.broadcast(files), f"{name}file")
    number = F.shiftleft(name, FILE_BITS).bitwiseOR(F.col(f"{name}place"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], number.alias(name)), name


def without(rows: DataFrame, name: str, gone: DataFrame) -> DataFrame:
    """`rows` of `numbered` less those whose number (column uid) is in `gone`, without the number.

    `gone` is written to the shared folder by file, and each task reads the places of its own
    files, so the rows themselves are neither shuffled nor joined.
    """
    spark, columns = rows.sparkSession, [c for c in rows.columns if c != name]
    folder = work_path(spark, "gone")
    places = gone.select(F.shiftright("uid", FILE_BITS).alias("file"), F.col("uid").bitwiseAND((1 << FILE_BITS) - 1).alias("place"))
    places.repartition("file").sortWithinPartitions("file", "place").write.partitionBy("file").parquet(folder)
    kind = rows.select(*columns).schema

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        known: dict[int, np.ndarray] = {}

        def listed(file: int) -> np.ndarray:
            if file not in known:
                known.clear()
                found = files.get_file_info(fs.FileSelector(f"{root}/file={file}", allow_not_found=True))
                parts = [pq.read_table(i.path, columns=["place"], filesystem=files, partitioning=None)["place"].to_numpy() for i in found if i.path.endswith(".parquet")]
                known[file] = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
            return known[file]

        for batch in batches:
            number = batch.column(batch.num_columns - 1).to_numpy()
            keep = np.ones(len(number), np.bool_)
            for file in np.unique(number >> FILE_BITS).tolist():
                own = np.flatnonzero(number >> FILE_BITS == file)
                keep[own] = ~np.isin(number[own] & ((1 << FILE_BITS) - 1), listed(file))
            yield batch.select(list(range(batch.num_columns - 1))).filter(pa.array(keep))
            release()

    return rows.select(*columns, name).mapInArrow(kept, kind)
