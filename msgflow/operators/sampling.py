"""Splits and samples that depend on row keys, not on partitions or attempts."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from msgflow import fixed_values as fv
from msgflow.operators.skew import portable_hash, unit_interval

_BUCKET_BITS = 16


def split_rows(df: DataFrame, key: str, weights: list[float] | None = None, seed: int = fv.SPLIT_SEED) -> list[DataFrame]:
    """Random split by weight. A row's part depends on its key and the seed alone.

    Parts are disjoint and together whole, also when a lost task is run again.
    """
    weights = fv.SPLIT_WEIGHTS if weights is None else weights
    total = float(sum(weights))
    bounds = [0.0, *(w / total for w in accumulate(weights))]
    spot = unit_interval(F.col(key), seed)
    return [df.where((spot >= lo) & (spot < hi)) for lo, hi in zip(bounds, bounds[1:])]


def sample_exact(df: DataFrame, key: str, fraction: float = fv.SAMPLE_FRACTION, seed: int = fv.SPLIT_SEED) -> DataFrame:
    """Random sample of exactly round(fraction * rows) rows, without replacement. `key` must be unique.

    Rows are ordered by a hash of the key. One partial aggregation counts the rows per hash bucket (at most
    2 ** 16 rows), which fixes the bucket that holds the cut. A second pass takes the rows of the buckets up to
    there; only those of the cut's own bucket are ranked, the others get numbers nobody looks at, in small groups.
    """
    hashed = df.withColumn("_hash", portable_hash(F.col(key), seed))
    bucket = F.shiftright("_hash", 32 - _BUCKET_BITS)
    counts = hashed.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    whole_table = Window.partitionBy(F.lit(0))
    upto = whole_table.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.bround(F.sum("_rows").over(whole_table) * F.lit(fraction)).cast("bigint")
    marks = (
        counts.withColumn("_before", F.sum("_rows").over(upto) - F.col("_rows"))
        .withColumn("_take", wanted - F.col("_before"))
        .where(F.col("_take") > 0)
        .select("_bucket", "_rows", "_take")
    )
    placed = hashed.withColumn("_bucket", bucket).join(F.broadcast(marks), "_bucket")
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    taken = placed.withColumn("_rank", rank).where(F.col("_rank") <= F.col("_take"))
    return taken.select(*[F.col(f"`{c}`") for c in df.columns])
