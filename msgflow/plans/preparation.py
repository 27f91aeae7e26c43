"""Training data, the gazetteer and channel ingest, each from raw input to table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow import fixed_values as fv
from msgflow.functions import records, text
from msgflow.operators import pages as channel_pages
from msgflow.operators import routing, sampling, state
from msgflow.operators.lookup import Lookup
from msgflow.operators.skew import one_per_key
from msgflow.session import discard, is_small, stage, work_path
from msgflow.sources import messages as feeds
from msgflow.sources import sinks, tables


def clean_labelled(raw: DataFrame) -> DataFrame:
    """Raw tweets to cleaned content and binary label; other columns are kept."""
    return raw.withColumns({
        "content": text.clean_text(F.col("content")),
        "label": records.binary_label(F.col("sentiment")),
    }).drop("sentiment")


def training_sample(
    cleaned: DataFrame, key: str, fraction: float = fv.SAMPLE_FRACTION, fields: tuple[str, ...] = ("content", "label")
) -> DataFrame:
    """A random fraction of the cleaned rows, with the selected fields only."""
    return sampling.sample_exact(cleaned, key, fraction).select(*fields)


def prepare_training(raw: DataFrame, key: str, cleaned_path: str, sample_path: str, fraction: float = fv.SAMPLE_FRACTION) -> None:
    """Write the cleaned table and a sample of it as CSV. The sample is drawn from the written table, which is parsed once."""
    spark = raw.sparkSession
    cleaned = clean_labelled(raw).select(key, "content", "label")
    sinks.write_csv(cleaned, cleaned_path)
    written = spark.read.schema(cleaned.schema).option("header", True).option("escape", '"').csv(cleaned_path)
    path = work_path(spark, "cleaned")
    sinks.write_csv(training_sample(stage(written, "cleaned", path), key, fraction), sample_path)
    discard(spark, path)


def build_gazetteer(spark: SparkSession, documents_path: str, cleaned_path: str, limit: int | None = None) -> DataFrame:
    """City documents to the cleaned gazetteer table, written as CSV and returned. No limit takes all cities."""
    cities = tables.read_gazetteer_documents(spark, documents_path)
    cities = cities if limit is None else tables.first_cities(cities, limit)
    sinks.write_csv(tables.normalise_gazetteer(cities), cleaned_path)
    return tables.read_gazetteer(spark, [cleaned_path])


def translation_requests(messages: DataFrame, config: DataFrame, catalog: DataFrame, seed: int = fv.SPLIT_SEED) -> DataFrame:
    """What to translate: messages with text of the channels that ask for it, each with a service, languages and one text.

    The service is drawn by votes from those that know the channel's languages; with
    several source languages the service is left to detect the one it meets.
    """
    sources = F.split(F.trim("translate_from"), r"\s+")
    options = config.where(records.option_flag(F.col("translation"))).select(
        "channel",
        F.when(F.size(sources) == 1, F.get(sources, F.lit(0))).otherwise("auto").alias("source"),
        F.col("translate_to").alias("target"),
        routing.required_language_set(F.concat(sources, F.array("translate_to"))).alias("required"),
    )
    asked = messages.where(F.size("text") > 0).select("channel", "id", text.join_parts(F.col("text")).alias("text"))
    asked = Lookup(options, "channel", is_small(options)).join(asked, ["channel", "id"], "inner")
    keyed = asked.withColumn("_key", F.concat_ws("/", "channel", "id"))
    return routing.route_weighted(keyed, catalog, "_key", seed, options).select("channel", "id", "service", "source", "target", "text")


def ingest_channels(
    pages: DataFrame, state_table: DataFrame, translations: DataFrame | None = None, config: DataFrame | None = None,
    stored: Callable[[DataFrame], DataFrame] | None = None, stage_path: str | None = None,
) -> DataFrame:
    """New messages of crawled channel pages, each once.

    New is what lies past the mark of its channel, or with `stored` what is not among the stored keys
    (channel, number), so that pages may come in any order. The parsed messages are then written to
    `stage_path` first, and `stored` is asked for the keys they may meet.

    `config` (resolved channel options) says where a channel without state starts,
    limits channels with a keyword query to messages that hold it, and keeps
    translations to the channels that ask for them.
    """
    if config is not None:
        state_table = state.starting_state(config, state_table if stored is None else state_table.limit(0))
    parsed = channel_pages.parse_channel_pages(pages)
    if stored is None:
        found = one_per_key(state.ingest_increment(parsed, state_table), ["channel", "id"])
    else:
        found = state.valid_messages(parsed) if config is None else state.ingest_increment(parsed, state_table)
        found = stage(one_per_key(found, ["channel", "id"]), "parsed", stage_path)
        found = state.not_stored(found, stored(found))
    if config is None:
        return found if translations is None else feeds.attach_translation(found, translations)
    options = config.select(
        "channel",
        F.lower(records.option_text(F.col("query"))).alias("_query"),
        records.option_flag(F.col("translation")).alias("_translate"),
    )
    body = F.lower(F.coalesce(F.array_join("text", "\n"), F.lit("")))
    found = Lookup(options, "channel", is_small(options)).join(found, ["channel", "id"])
    found = found.where(F.col("_query").isNull() | F.contains(body, F.col("_query")))
    if translations is not None:
        found = feeds.attach_translation(found, translations)
        wanted = F.when(F.col("_translate"), F.col("translation"))
        found = found.withColumn("translation", wanted)
    return found.drop("_query", "_translate")
