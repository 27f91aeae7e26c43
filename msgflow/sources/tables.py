"""Bounded readers: labelled texts, gazetteer, service catalog, channel options, ingest state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow import fixed_values as fv
from msgflow import schemas
from msgflow.functions import geo
from msgflow.operators.domains import suffix_rules
from msgflow.operators.skew import first_per_key


def read_labelled(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Labelled English texts: CSV with a header and at least content and label.

    Types are given by default; `infer=True` reads the whole file a second time to guess them.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schemas.LABELLED_TEXT).csv(path)


def read_labelled_italian(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LABELLED_TEXT_ITALIAN).option("header", True).option("escape", '"').csv(path, sep=",")


def read_raw_tweets(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV with given column names; only sentiment and content are kept."""
    raw = spark.read.schema(schemas.RAW_TWEET).option("header", False).option("escape", '"').csv(path)
    return raw.drop("id", "date", "query_string", "user")


def read_gazetteer_documents(spark: SparkSession, path: str) -> DataFrame:
    """City rows from JSON documents (one per line), each with a `results` array.

    `pos` grows in source order over all documents: by path of the file, place in it, and place in the document.
    It has gaps. Ranges of cities are sorted, each in a task of its own; documents are no unit of work.
    """
    documents = spark.read.schema(schemas.GAZETTEER_DOCUMENT).json(path)
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line")]
    cities = documents.select(*place, F.posexplode("results").alias("_index", "city"))
    ordered = cities.sort("_file", "_block", "_line", "_index")
    return ordered.select(F.monotonically_increasing_id().alias("pos"), "city.*")


def read_suffixes(spark: SparkSession, path: str) -> DataFrame:
    """Rules of public suffixes from a text file, one a line."""
    return suffix_rules(spark.read.text(path))


def normalise_gazetteer(cities: DataFrame) -> DataFrame:
    """Lower-case names and coordinates out of the location text."""
    return cities.select(
        "pos",
        F.lower("name").alias("name"),
        F.col("population").cast("string").alias("population"),
        geo.coordinate(F.col("location"), 1).alias("latitude"),
        geo.coordinate(F.col("location"), 2).alias("longitude"),
    )


def first_cities(cities: DataFrame, limit: int = fv.GAZETTEER_LIMIT) -> DataFrame:
    """The first cities of the source, in source order (the limit of one fetch)."""
    return cities.orderBy("pos").limit(limit)


def read_gazetteer(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """The first cleaned gazetteer that can be read, None when there is none."""
    for path in paths:
        try:
            return spark.read.schema(schemas.GAZETTEER).option("header", True).option("escape", '"').csv(path)
        except Exception as error:  # noqa: BLE001 - a missing file is reported, the next one tried
            print(f"gazetteer {path} not readable: {type(error).__name__}")
    return None


def gazetteer_lookup(gazetteer: DataFrame) -> DataFrame:
    """One row per name that can match a token: the first one in file order."""
    fits = gazetteer.where(F.length("name").between(fv.MIN_PLACE_LENGTH, fv.MAX_PLACE_LENGTH))
    return first_per_key(fits.select("name", "pos", "latitude", "longitude"), "name", "pos").drop("pos")


def parse_catalog(lines: DataFrame, line: str = "value") -> DataFrame:
    """Service catalog from text lines: service, vote and languages separated by white space."""
    words = F.split(F.trim(line), r"\s+")
    others = [c for c in lines.columns if c != line]
    return (
        lines.where(F.trim(line) != "")
        .select(*others, words.alias("w"))
        .select(
            *others,
            F.get("w", F.lit(0)).alias("service"),
            F.get("w", F.lit(1)).cast("bigint").alias("vote"),
            F.slice("w", F.lit(3), F.greatest(F.size("w") - 2, F.lit(0))).alias("langs"),
        )
    )


def service_catalog(spark: SparkSession) -> DataFrame:
    """The built-in catalog with its line position."""
    lines = [(i, text) for i, text in enumerate(fv.SERVICE_CATALOG.splitlines())]
    return parse_catalog(spark.createDataFrame(lines, "pos bigint, value string"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog file of at most a few hundred lines, in line order.

    Read as one whole text, since the order of lines decides the vote ranges.
    """
    text = spark.read.text(path, wholetext=True)
    return parse_catalog(text.select(F.posexplode(F.split("value", r"\r?\n")).alias("p", "value")).select(F.col("p").cast("bigint").alias("pos"), "value"))


def option_columns() -> list[str]:
    return list(fv.CHANNEL_DEFAULTS)


def resolve_channel_config(overrides: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """Channel options with the defaults inherited where a channel sets nothing."""
    defaults = {**fv.CHANNEL_DEFAULTS, **(defaults or {})}

    def option(name: str) -> Column:
        default = F.lit(defaults[name])
        return (F.coalesce(F.col(name), default) if name in overrides.columns else default).alias(name)

    return overrides.select("channel", *[option(name) for name in defaults])


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Ingest state: last id and transaction counter per channel."""
    return spark.read.schema(schemas.INGEST_STATE).parquet(path)
