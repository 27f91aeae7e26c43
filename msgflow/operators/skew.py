"""Joins and reductions that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from msgflow.session import discard, is_small, stage, work_path

# A key is hot when it holds more than this share of all rows, so there are fewer
# than 1 / HOT_SHARE hot keys: the broadcast list of them is bounded by that.
HOT_SHARE = 0.005
_NULL_SALTS = 1024
# A batch with at most so many keys names them all to the lookup it is joined with.
FEW_KEYS, FEW_BYTES = 20_000, 4 << 20


def hot_keys(facts: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys above the share, with the number of pieces each is split into (rows: under 1 / share)."""
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    limit = counts.agg((F.sum("n") * F.lit(share)).alias("n")).scalar()
    return counts.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int").alias("_salts"))


def frequent_keys(facts: DataFrame, key: str, share: float = HOT_SHARE) -> tuple[list, list | None]:
    """Keys above the share of all rows, fewer than 1 / share, and all keys where those are few (else None).

    Keys are counted exactly, in one pass with map-side combine. Only what is returned reaches the driver:
    both lists are bounded, so they may stand in a plan.
    """
    spark = facts.sparkSession
    path = work_path(spark, "key-counts")
    counts = stage(facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")), "key-counts", path)
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = sorted(row[0] for row in counts.where(F.col("n") > total * share).select(key).collect())
    few = is_small(counts.select(key), FEW_KEYS, FEW_BYTES)
    keys = sorted(row[0] for row in counts.select(key).collect()) if few else None
    discard(spark, path)
    return hot, keys


def skew_join(
    facts: DataFrame, dim: DataFrame, key: str, spread: list[str], how: str = "left",
    counted: DataFrame | None = None, share: float = HOT_SHARE,
) -> DataFrame:
    """Join `facts` to `dim` on one key, with hot keys split into pieces.

    Rows of a hot key are spread over its pieces by a hash of the `spread` columns
    (they should tell the rows apart); only the dimension rows of hot keys are
    repeated, once per piece. Every fact row meets every dimension row of its key
    exactly once, so the result is that of the plain join. Keys are counted in
    `counted`, which is `facts` itself unless given: where that is expensive to
    compute, stage it first, since it is then read twice.
    """
    hot = F.broadcast(hot_keys(facts if counted is None else counted, key, share))
    spot = F.xxhash64(*spread)
    salted = (
        facts.join(hot, key, "left")
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), F.pmod(spot, F.lit(_NULL_SALTS)))
            .otherwise(F.coalesce(F.pmod(spot, F.col("_salts")), F.lit(0)))
            .cast("int"),
        )
        .drop("_salts")
    )
    repeated = (
        dim.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0)))))
        .drop("_salts")
    )
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """First row of every key. A reduction with map-side combine: a hot key sends one row per task."""
    others = [c for c in df.columns if c not in (key, order)]
    first = F.min(F.struct(order, *others)).alias("_first")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(first).select(key, "_first.*")


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per combination of keys, the least by its other columns in order; the same one on every attempt."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    least = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_least"))
    return least.select(*keys, "_least.*").select(*[F.col(f"`{c}`") for c in df.columns])


def without_copies(df: DataFrame, key: str, order: str) -> DataFrame:
    """First row of every key, for wide rows that mostly have a key of their own.

    Only (key, order) is aggregated, and only keys that occur more than once are
    looked up again, so wide rows are not sorted and cross no shuffle while those
    keys are few. Rows without a key are dropped.
    """
    keyed = df.where(F.col(key).isNotNull())
    firsts = (
        keyed.groupBy(key).agg(F.min(order).alias("_first"), F.count("*").alias("_copies"))
        .where(F.col("_copies") > 1).drop("_copies").withColumn("_many", F.lit(True))
    )
    if is_small(firsts):
        marked = keyed.join(F.broadcast(firsts), key, "left")
    else:
        marked = skew_join(keyed, firsts, key, [order])
    marked = marked.withColumn("_single", F.col("_many").isNull()).drop("_many")
    # Keys without copies have no entry. Of the others only the first rows go on, and rows that tie are reduced to one.
    single = marked.where(F.col("_first").isNull() & F.col("_single")).drop("_first", "_single")
    tied = marked.where(~F.col("_single") & F.col(order).eqNullSafe(F.col("_first"))).drop("_first", "_single")
    return single.unionByName(one_per_key(tied, [key]))


def running_total(df: DataFrame, order: str, value: str, output: str, block: int = 100_000) -> DataFrame:
    """Running sum over a dense integer position, in blocks.

    Block sums come from a partial aggregation, are accumulated over one row per
    block, and are added to the running sum inside each block.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / block))
    sums = blocked.groupBy("_block").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.withColumn("_running", F.sum(value).over(inside))
        .join(offsets, "_block")
        .withColumn(output, F.col("_running") + F.col("_offset"))
        .drop("_block", "_running", "_offset")
    )


def unit_interval(key: Column, seed: int) -> Column:
    """A value in [0, 1) fixed by the key and the seed, in 2^32 steps."""
    return portable_hash(key, seed) / F.lit(float(1 << 32))


def portable_hash(key: Column, seed: int) -> Column:
    """32-bit hash of a key, the same on every engine that has MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
