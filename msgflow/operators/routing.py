"""Weighted choice of a translation service per message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from msgflow import fixed_values as fv
from msgflow.operators.skew import portable_hash

# A pseudo language every service supports and every message requires, so that a
# message without any known language is matched by the same equi-join.
_ANY = "*"


def _known() -> Column:
    return F.array(*[F.lit(code) for code in fv.KNOWN_LANGUAGES])


def required_language_set(languages: Column) -> Column:
    """Known languages among an array of them, in order of the known list; unknown ones are ignored."""
    return F.array_intersect(_known(), languages)


def required_languages(*languages: Column) -> Column:
    return required_language_set(F.array(*languages))


def unknown_languages(*languages: Column) -> Column:
    """The languages that `required_languages` ignores, for a warning."""
    return F.array_except(F.array(*languages), _known())


def supports(langs: Column, required: Column) -> Column:
    """True when every required language is supported."""
    return F.size(F.array_except(required, langs)) == 0


def cumulative_votes(services: DataFrame, group: str | None = None) -> DataFrame:
    """Vote range [lo, hi) of every service, in catalog order, per group of services.

    A group holds at most one row per service of the catalog.
    """
    by_position = (Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))).orderBy("pos")
    running = F.sum("vote").over(by_position.rowsBetween(Window.unboundedPreceding, 0))
    return services.withColumn("hi", running).withColumn("lo", F.col("hi") - F.col("vote"))


def total_votes(services: DataFrame) -> DataFrame:
    return services.agg(F.coalesce(F.sum("vote"), F.lit(0)).cast("bigint").alias("votes"))


def eligible_services(requirements: DataFrame, catalog: DataFrame) -> DataFrame:
    """Services that support every language of a requirement, for each distinct requirement.

    `requirements` has an array column `required`. Relational division on the
    language: a service stays when it matches as many languages as are required.
    Distinct requirements are subsets of the known languages, so there are at
    most 2 ** len(known) of them whatever the number of messages.
    """
    distinct = requirements.select("required").distinct()
    wanted = distinct.select(
        "required", (F.size("required") + 1).alias("_needed"),
        F.explode(F.concat(F.col("required"), F.array(F.lit(_ANY)))).alias("_lang"),
    )
    offered = catalog.select(
        "pos", "service", "vote",
        F.explode(F.array_distinct(F.concat(F.col("langs"), F.array(F.lit(_ANY))))).alias("_lang"),
    )
    return (
        wanted.join(offered, "_lang")
        .groupBy("required", "pos", "service", "vote", "_needed")
        .agg(F.count("*").alias("_matched"))
        .where(F.col("_matched") == F.col("_needed"))
        .select("required", "pos", "service", "vote")
    )


def route_weighted(
    messages: DataFrame, catalog: DataFrame, key: str, seed: int | None = None, requirements: DataFrame | None = None
) -> DataFrame:
    """Add `service`, chosen with probability proportional to its votes.

    `messages` carries `required` (see `required_languages`) and a key. The slot of
    a message is its key modulo the votes of its eligible services, or, with a
    seed, a hash of the key. The service whose range [lo, hi) holds the slot is
    taken: services without votes are never chosen, and a message that no service
    can serve gets null. Leave a failed service out of `catalog` to route around it.
    `requirements` may name a smaller table that holds every `required` of the messages.
    """
    ranged = cumulative_votes(eligible_services(messages if requirements is None else requirements, catalog), "required")
    # one row per requirement, holding at most one range per service of the catalog
    routes = ranged.groupBy("required").agg(
        F.sum("vote").alias("_total"), F.array_sort(F.collect_list(F.struct("hi", "lo", "service"))).alias("_ranges")
    )
    number = F.col(key).cast("bigint") if seed is None else portable_hash(F.col(key), seed)
    slot = F.pmod(number, F.when(F.col("_total") > 0, F.col("_total")))
    routed = messages.join(F.broadcast(routes), "required", "left").withColumn("_slot", slot)
    chosen = F.filter("_ranges", lambda r: (F.col("_slot") >= r["lo"]) & (F.col("_slot") < r["hi"]))
    return routed.withColumn("service", F.get(chosen, F.lit(0))["service"]).drop("_total", "_ranges", "_slot")
