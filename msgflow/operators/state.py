"""Incremental ingest: high-water marks per channel, crawl frontier, option merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.functions import records
from msgflow.operators.lookup import Lookup
from msgflow.session import is_small


def valid_messages(messages: DataFrame) -> DataFrame:
    """Messages whose id is a non-negative integer."""
    return messages.where(records.valid_id(F.col("id")))


def between_ids(messages: DataFrame, min_id: int | None = None, max_id: int | None = None) -> DataFrame:
    """Messages after `min_id` (not included) up to `max_id` (included)."""
    number = F.col("id").try_cast("bigint")
    kept = messages if min_id is None else messages.where(number > min_id)
    return kept if max_id is None else kept.where(number <= max_id)


def matching_query(messages: DataFrame, query: str | None) -> DataFrame:
    """Messages whose text holds the keywords, in any case; all messages without a query."""
    if query is None:
        return messages
    return messages.where(F.contains(F.lower(F.array_join("text", "\n")), F.lit(query.lower())))


def ingest_increment(messages: DataFrame, state: DataFrame) -> DataFrame:
    """Valid messages past the stored id of their channel; every message of a channel without state."""
    marks = state.select("channel", F.col("last_id").alias("_last"))
    number = F.col("id").try_cast("bigint")
    return (
        Lookup(marks, "channel", is_small(marks))
        .join(valid_messages(messages), ["channel", "id"], counted=messages)
        .where(number > F.coalesce("_last", F.lit(-1)))
        .drop("_last")
    )


def not_stored(messages: DataFrame, keys: DataFrame) -> DataFrame:
    """Messages whose (channel, id) is not among the stored keys (channel, number), whatever their order.

    The join is on both columns, so a channel with very many messages is spread over all tasks.
    """
    numbered = messages.withColumn("_number", F.col("id").try_cast("bigint"))
    same = numbered["channel"].eqNullSafe(keys["channel"]) & (numbered["_number"] == keys["number"])
    return numbered.join(keys, same, "left_anti").drop("_number")


def append_batches(batches: list[DataFrame], once: bool = True) -> DataFrame:
    """Batches of messages as one table, in which columns a batch lacks are null; with `once` every distinct row is kept once."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
    return rows.distinct() if once else rows


def starting_state(config: DataFrame, state: DataFrame) -> DataFrame:
    """Stored state, and for configured channels without one the id their options start from.

    Method `all` starts after the configured id, any other one at the first id.
    """
    configured = F.when(F.lower("method") == "all", F.col("_first").cast("bigint")).otherwise(0)
    options = config.select("channel", F.col("last_id").alias("_first"), "method")
    return options.join(state, "channel", "full").select(
        "channel", F.coalesce("last_id", configured).alias("last_id"), "transaction_id"
    )


def channel_marks(messages: DataFrame) -> DataFrame:
    """Largest id per channel. Partial maxima are taken before the shuffle."""
    return valid_messages(messages).groupBy("channel").agg(F.max(F.col("id").try_cast("bigint")).alias("max_id"))


def advance_state(state: DataFrame, messages: DataFrame) -> DataFrame:
    """State after one write of `messages`.

    A mark never moves back, and the counter of every channel that was written goes up by one.
    """
    old = state.select("channel", F.col("last_id").alias("_last"), F.col("transaction_id").alias("_counter"), F.lit(True).alias("_old"))
    merged = old.join(channel_marks(messages), "channel", "full")
    written = F.col("max_id").isNotNull()
    return merged.select(
        "channel",
        F.greatest(F.coalesce("_last", F.lit(0)), F.coalesce("max_id", F.lit(0))).cast("bigint").alias("last_id"),
        F.when(written, records.next_transaction(F.col("_counter"))).otherwise(F.col("_counter")).cast("bigint").alias("transaction_id"),
    )


def merge_state(config: DataFrame, state: DataFrame) -> DataFrame:
    """Channel options with the stored id and counter taken over.

    Only where the channel allows it and the counter has changed. Ids stay text, as options are.
    """
    stored = state.select("channel", F.col("last_id").alias("_last"), F.col("transaction_id").alias("_counter"))
    joined = config.join(stored, "channel", "left")
    changed = (
        records.option_flag(F.col("overwrite_last_id"))
        & F.col("_counter").isNotNull()
        & (F.col("_counter").cast("string") != F.col("transaction_id"))
    )
    newest = F.greatest(F.col("_last"), F.col("last_id").cast("bigint")).cast("string")
    return joined.withColumns({
        "last_id": F.when(changed, newest).otherwise(F.col("last_id")),
        "transaction_id": F.when(changed, F.col("_counter").cast("string")).otherwise(F.col("transaction_id")),
    }).drop("_last", "_counter")


def crawl_frontier(config: DataFrame, state: DataFrame) -> DataFrame:
    """Next page to fetch per channel: from the configured id, or after the stored one, with the keyword query."""
    marks = state.select("channel", F.col("last_id").alias("_after"))
    query = records.query_text(records.option_text(F.col("query")))
    first = records.channel_page_url(F.col("channel"), F.col("last_id"), [("q", query)])
    after = records.channel_page_url(F.col("channel"), None, [("q", query), ("after", F.col("_after"))])
    return (
        config.join(marks, "channel", "left")
        .select("channel", F.when(F.col("_after").isNull(), first).otherwise(after).alias("next_url"))
    )
