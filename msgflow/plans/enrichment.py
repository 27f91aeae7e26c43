"""The two enrichment queries. Each takes a batch or a stream of decoded messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow import fixed_values as fv
from msgflow.functions import text
from msgflow.operators.enrich import (
    Lookup,
    enrich_pages,
    enrich_whois,
    explode_sentences,
    explode_urls,
    match_cities,
    page_lookup,
    whois_lookup,
)
from msgflow.operators.sentiment import score
from msgflow.session import stage
from msgflow.sources.messages import decode_translation


def cited_urls(messages: DataFrame) -> DataFrame:
    """Id, channel, timestamp and link of every link in a message's text."""
    return explode_urls(explode_sentences(messages)).drop("data")


@dataclass
class LinkLookups:
    """What the link query looks up: page contents, registrations, and the label of a missing page."""

    pages: Lookup
    registry: Lookup
    missing_label: str | None
    suffixes: DataFrame | None = None

    @property
    def small(self) -> bool:
        return self.pages.small and self.registry.small

    def staged(self) -> LinkLookups:
        """Computed once and written to the shared folder; for streams, which read them in every batch."""
        suffixes = None if self.suffixes is None else stage(self.suffixes, "suffixes")
        return LinkLookups(self.pages.staged("page-contents"), self.registry.staged("registrations"), self.missing_label, suffixes)


def link_lookups(pages: DataFrame, registry: DataFrame, model: PipelineModel | None = None, suffixes: DataFrame | None = None) -> LinkLookups:
    """Lookups of the link query. With a model, a page is scored once, not once per citation. `suffixes` are rules of public suffixes."""
    contents = page_lookup(pages)
    if model is None:
        return LinkLookups(contents, whois_lookup(registry), None, suffixes)
    contents = Lookup(score(contents.rows, model), contents.key, contents.small)
    missing = score(pages.sparkSession.createDataFrame([(fv.MISSING_PAGE_TEXT,)], "content string"), model).first()
    return LinkLookups(contents, whois_lookup(registry), missing["emotion_detection"], suffixes)


def link_intelligence(messages: DataFrame, lookups: LinkLookups, stage_path: str | None = None) -> DataFrame:
    """Links of messages with page text, registration and sentiment of the page.

    Registrations are joined first, while rows are narrow; the page text is joined
    last and crosses no further shuffle. For lookups beyond broadcast size the extracted links are
    written first, to `stage_path` (overwriting it) where one is given, so that counting their
    keys does not extract them again.
    """
    urls = cited_urls(messages)
    if not lookups.small and not messages.isStreaming:
        urls = stage(urls, "cited-urls", stage_path)
    linked = enrich_pages(enrich_whois(urls, lookups.registry, suffixes=lookups.suffixes), lookups.pages, counted=urls)
    columns = ["id", "channel", "`@timestamp`", "content", "url", "whois"]
    if lookups.missing_label is None:
        return linked.select(*columns)
    label = F.coalesce("emotion_detection", F.lit(lookups.missing_label))
    return linked.select(*columns, label.alias("emotion_detection"))


def message_analysis(
    messages: DataFrame, gazetteer: DataFrame | Lookup, model: PipelineModel | None = None, stage_path: str | None = None
) -> DataFrame:
    """Cited cities of translated messages, with the sentiment of the message.

    A message is scored once, before its cities are exploded: the work stays linear in the text. With a gazetteer
    beyond broadcast size the scored messages are written to `stage_path` first.
    """
    contents = decode_translation(messages).select(
        "id", "channel", "timestamp", text.clean_text(F.col("text")).alias("content")
    )
    columns = ["id", "channel", "timestamp", F.col("content").alias("traduction")]
    if model is not None:
        contents = score(contents, model)
        columns.append("emotion_detection")
    return match_cities(contents, gazetteer, "content", cleaned=True, stage_path=stage_path).select(*columns, "city", "location")
