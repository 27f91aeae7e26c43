"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Applied on top of what the cluster sets; AQE sizes and splits partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's `spark.checkpoint.dir`.

    Only a local session may go without one; there a temporary folder is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = getattr(shared_folder, "local_folder", None)
    if folder is None:
        folder = shared_folder.local_folder = tempfile.mkdtemp(prefix="msgflow-")
    return folder


_made: list[tuple[str, str | None]] = []  # work paths of this process, with the table over each where there is one


def work_path(spark: SparkSession, label: str, table: str | None = None) -> str:
    """A fresh path under the shared folder, which `clear_work` deletes."""
    path = f"{shared_folder(spark)}/msgflow/{label}-{uuid.uuid4().hex}"
    _made.append((path, table))
    return path


def clear_work(spark: SparkSession) -> int:
    """Delete all work tables this process has made, and their names in the catalog; how many.

    For the end of a job: results that are still to be read need theirs.
    """
    done = len(_made)
    while _made:
        path, table = _made.pop()
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        discard(spark, path)
    return done


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back. A given path is overwritten.

    Used where a result feeds several branches: the input is scanned once, and
    a lost executor costs a re-read of the table, not the work behind it.
    """
    spark = df.sparkSession
    path = path or work_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a work table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage_by_key(df: DataFrame, label: str, key: str) -> DataFrame:
    """`stage` into buckets of one key: a later join on the key does not shuffle this side."""
    spark = df.sparkSession
    name = f"staged_{uuid.uuid4().hex}"
    path = work_path(spark, label, name)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table that lies in fewer files, and fewer splits of them, than there are cores.

    For text work on small files: only the names and sizes of a few files are looked at. A large table is left as it is.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if not files or len(files) >= cores:
        return df
    places = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)) for file in files]
    sizes = [p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in places]
    split = 128 << 20  # Spark's default size of a split
    return df if sum(-(-size // split) for size in sizes) >= cores else df.repartition(cores)


def is_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 32 << 20) -> bool:
    """Measured check that a lookup side may be broadcast.

    Fetches the sizes of a thousand rows, then of at most `max_rows` + 1. Spark takes
    them from as few partitions as hold that many, so a large table is not scanned.
    """
    texts = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)).cast("bigint") for f in df.schema.fields
    ]
    width = sum(texts[1:], texts[0]) if texts else F.lit(0).cast("bigint")
    sizes = df.select(width.alias("size"))
    for rows in (min(1_000, max_rows + 1), max_rows + 1):
        found = sizes.take(rows)
        if sum(row["size"] for row in found) > max_bytes:
            return False
        if len(found) < rows:
            return True
    return False
