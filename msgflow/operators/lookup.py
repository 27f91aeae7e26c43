"""A lookup table: one row per key, joined by broadcast, or beyond that size in buckets of its key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.operators.skew import HOT_SHARE, frequent_keys
from msgflow.session import stage, stage_by_key


@dataclass
class Lookup:
    """A lookup table with one row per key, and whether it was measured to be small enough to broadcast."""

    rows: DataFrame
    key: str
    small: bool

    def staged(self, label: str) -> Lookup:
        """The same lookup, computed once and written to the shared folder.

        A large one is written in buckets of its key, so that joins on the key do not shuffle it.
        """
        rows = stage(self.rows, label) if self.small else stage_by_key(self.rows, label, self.key)
        return Lookup(rows, self.key, self.small)

    def join(self, facts: DataFrame, spread: list[str], how: str = "left", counted: DataFrame | None = None) -> DataFrame:
        """Join facts on the key: broadcast when small, beyond that `bucketed_join`.

        `counted` holds the same keys as the facts and is cheaper to count. Counting
        needs a batch: a stream joins a large lookup inside `foreachBatch`.
        """
        if self.small:
            return facts.join(F.broadcast(self.rows), self.key, how)
        if facts.isStreaming:
            raise ValueError("join a lookup beyond broadcast size per micro-batch, in foreachBatch")
        return self.bucketed_join(facts, spread, how, counted)

    def bucketed_join(
        self, facts: DataFrame, spread: list[str], how: str = "left", counted: DataFrame | None = None, share: float = HOT_SHARE
    ) -> DataFrame:
        """Join facts with a lookup that is too large to broadcast, without moving the lookup.

        Hot keys, fewer than 1 / `share`, are named one by one: only their buckets of the lookup are
        read for them, and their rows are broadcast. All other rows are shuffled on the key alone to the
        lookup's buckets. Rows of hot keys and those without a key go to buckets by a hash of the
        `spread` columns instead; they may meet a lookup row there by chance, which is not taken.

        When the facts have few keys (measured), the lookup is first cut to those, so that a small
        batch decodes and sorts few of its rows.
        """
        key, values = self.key, [c for c in self.rows.columns if c != self.key]
        hot, keys = frequent_keys(facts if counted is None else counted, key, share)
        kind = self.rows.schema[key].dataType.simpleString()

        def listed(found: list) -> DataFrame:
            return facts.sparkSession.createDataFrame([(k,) for k in found], f"`{key}` {kind}")

        packed = F.struct(*[F.col(f"`{c}`") for c in values])
        known = self.rows.where(F.col(key).isin(hot)).select(key, packed.alias("_hot_row"))
        named = listed(hot).join(F.broadcast(known), key, "left").withColumn("_hot", F.lit(True))

        rest = self.rows
        if keys is not None:
            rest = rest.join(F.broadcast(listed(keys)), key, "left_semi")
        rest = rest.select(F.col(f"`{key}`").alias("_probe"), packed.alias("_row"))
        marked = facts.join(F.broadcast(named), key, "left")
        alone = F.col(key).isNotNull() & F.col("_hot").isNull()
        elsewhere = F.xxhash64(*[F.col(c) for c in spread]).cast(kind)
        marked = marked.withColumns({"_alone": alone, "_probe": F.when(alone, F.col(key)).otherwise(elsewhere)})
        joined = marked.join(rest, "_probe", "left")
        found = F.when(F.col("_alone"), F.col("_row")).otherwise(F.col("_hot_row"))
        joined = joined.withColumn("_found", found).drop("_probe", "_alone", "_hot", "_hot_row", "_row")
        if how == "inner":
            joined = joined.where(F.col("_found").isNotNull())
        return joined.select("*", *[F.col("_found").getField(c).alias(c) for c in values]).drop("_found")
