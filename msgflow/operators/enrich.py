"""Lookups as joins: crawled pages, domain registrations, cited places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow import fixed_values as fv
from msgflow.functions import geo, text, whois
from msgflow.functions.records import page_key
from msgflow.operators.domains import with_domain
from msgflow.operators.lookup import Lookup
from msgflow.operators.skew import first_per_key, without_copies
from msgflow.session import is_small, stage
from msgflow.sources.tables import gazetteer_lookup


def explode_sentences(messages: DataFrame) -> DataFrame:
    """One row per text part. Messages without text give none."""
    return messages.select("id", "channel", "`@timestamp`", "data", F.explode("text").alias("sentence"))


def explode_urls(sentences: DataFrame) -> DataFrame:
    """One row per link of a sentence, with its protocol. Sentences without a link give none."""
    links = F.explode(text.extract_urls(F.col("sentence"))).alias("url")
    return sentences.select("id", "channel", "`@timestamp`", "data", links)


def page_lookup(pages: DataFrame) -> Lookup:
    """Cleaned visible text per page key; the smallest page id wins where pages share a key.

    Pages with a `status` outside 200-399 or without markup count as not loaded.
    """
    small = is_small(pages.select("url", "html"))
    loaded = F.col("html").isNotNull()
    if "status" in pages.columns:
        loaded = loaded & F.col("status").between(200, 399)
    keyed = pages.withColumn("_page", page_key(F.col("url")))
    if not small:
        keyed = without_copies(keyed, "_page", "page_id")
    body = F.when(loaded, text.visible_text(F.col("html"))).otherwise(fv.MISSING_PAGE_TEXT)
    contents = keyed.select("_page", "page_id", text.clean_text(body).alias("content"))
    rows = first_per_key(contents, "_page", "page_id") if small else contents
    return Lookup(rows.drop("page_id"), "_page", small)


def enrich_pages(urls: DataFrame, pages: DataFrame | Lookup, counted: DataFrame | None = None) -> DataFrame:
    """Left join of links with page contents; a link without a page gets the missing-page text.

    `counted` may name the links before other lookups were joined to them.
    """
    lookup = pages if isinstance(pages, Lookup) else page_lookup(pages)
    key = page_key(F.col("url"))
    base = None if counted is None else counted.select(key.alias("_page"))
    joined = lookup.join(urls.withColumn("_page", key), urls.columns, counted=base)
    return joined.withColumn("content", F.coalesce("content", F.lit(fv.MISSING_PAGE_TEXT))).drop("_page")


def whois_lookup(registry: DataFrame) -> Lookup:
    """One registration per domain; where there are several, the least one by its fields in order."""
    rows = registry.select(F.lower("domain").alias("_domain"), F.lit(0).alias("_order"), *fv.WHOIS_FIELDS)
    return Lookup(first_per_key(rows, "_domain", "_order").drop("_order"), "_domain", is_small(registry))


def whois_columns() -> dict[str, Column]:
    return {name: whois.printed_field(name) for name in fv.WHOIS_FIELDS}


def enrich_whois(urls: DataFrame, registry: DataFrame | Lookup, as_json: bool = True, suffixes: DataFrame | None = None) -> DataFrame:
    """Left join of links with the registration of their domain.

    The domain follows the rules of `suffixes` (`suffix_rules`), or the built-in two-label suffixes.

    Adds the JSON text `whois`, or the printed fields one by one (prefix `whois_`).
    A domain is where links pile up: beyond broadcast size hot domains are split.
    """
    lookup = registry if isinstance(registry, Lookup) else whois_lookup(registry)
    if suffixes is None:
        keyed = urls.withColumn("_domain", whois.registered_domain(F.col("url")))
    else:
        keyed = with_domain(urls, suffixes, "url", "_domain")
    joined = lookup.join(keyed, urls.columns)
    fields = whois_columns()
    kept = [F.col(f"`{c}`") for c in urls.columns]
    if as_json:
        return joined.select(*kept, whois.whois_json(fields).alias("whois"))
    return joined.select(*kept, *[value.alias(f"whois_{name}") for name, value in fields.items()])


def place_lookup(gazetteer: DataFrame) -> Lookup:
    """City and point per name of the cleaned gazetteer (pos, name, population, latitude, longitude)."""
    point = geo.wkt_point(F.col("longitude"), F.col("latitude"))
    rows = gazetteer_lookup(gazetteer).select(F.col("name").alias("city"), point.alias("location"))
    return Lookup(rows, "city", is_small(gazetteer.select("name", "latitude", "longitude")))


def match_cities(
    messages: DataFrame, gazetteer: DataFrame | Lookup, content: str, cleaned: bool = False, stage_path: str | None = None
) -> DataFrame:
    """One row per token that names a city, with the city and its point. Repeats are kept.

    `cleaned` text is in lower case and parted by single spaces, which saves most of the work per token.

    With a gazetteer beyond broadcast size the join has two phases: messages are written once with a number (to
    `stage_path`, which is overwritten, where one is given), only (number, token) goes to the gazetteer, and what
    is found comes back by number. So a text is moved once, whatever the number of its tokens.
    """
    lookup = gazetteer if isinstance(gazetteer, Lookup) else place_lookup(gazetteer)
    parts = F.split(content, " " if cleaned else text.WHITESPACE)
    numbered, columns = messages, [F.col(f"`{c}`") for c in messages.columns]
    if not lookup.small and not messages.isStreaming:
        numbered = stage(messages.withColumn("_message", F.monotonically_increasing_id()), "numbered-messages", stage_path)
        columns = [F.col("_message")]
    tokens = numbered.select(*columns, F.explode(parts).alias("city")).where(text.fits_place(F.col("city")))
    if not cleaned:
        tokens = tokens.withColumn("city", F.lower("city"))
    if lookup.small or messages.isStreaming:
        return lookup.join(tokens, messages.columns, "inner")
    found = lookup.join(tokens, ["_message"], "inner")
    return numbered.join(found, "_message").drop("_message")
