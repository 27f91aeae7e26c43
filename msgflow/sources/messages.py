"""Message feeds: stream and batch readers, JSON envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow import schemas
from msgflow.operators.skew import one_per_key


def read_message_stream(
    spark: SparkSession,
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    starting: str = "latest",
    per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded feed with one string column `value` holding a JSON message.

    With `servers` and `topic` the feed is a Kafka topic, read from `starting`
    offsets and resumed from the sink's checkpoint (needs the Kafka connector on
    the classpath). With `path` it is a folder of text files, one message per
    line. `per_trigger` bounds a micro-batch: offsets for Kafka, files otherwise.
    """
    if path is not None:
        reader = spark.readStream.format("text")
        if per_trigger:
            reader = reader.option("maxFilesPerTrigger", per_trigger)
        return reader.load(path)
    if servers is None or topic is None:
        raise ValueError("give either a path or Kafka servers and a topic")
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    """The same feed as a bounded table."""
    return spark.read.text(path)


def decode_messages(feed: DataFrame) -> DataFrame:
    """JSON envelopes to message columns. Absent fields are null, a malformed envelope is all null."""
    return feed.select(F.from_json(F.col("value").cast("string"), schemas.MESSAGE).alias("d")).select("d.*")


def decode_translation(messages: DataFrame) -> DataFrame:
    """Id, channel, timestamp and the translation's service and text.

    The text of a translation is a JSON array on the wire and stays its raw text here.
    """
    return messages.select(
        "id",
        "channel",
        F.col("`@timestamp`").alias("timestamp"),
        F.from_json("translation", schemas.TRANSLATION).alias("tr"),
    ).select("id", "channel", "timestamp", "tr.*")


def ingest_json_batches(feed: DataFrame, kind: str = "syslog") -> DataFrame:
    """JSON arrays of messages to one event per message, with type and intake time added.

    A time the message already carries is kept.
    """
    batch = F.from_json(F.col("value").cast("string"), T.ArrayType(schemas.MESSAGE))
    events = feed.select(F.explode(batch).alias("d")).select("d.*")
    return events.withColumns({
        "@timestamp": F.coalesce(F.col("`@timestamp`"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
        "type": F.lit(kind),
    })


def to_json_value(df: DataFrame) -> DataFrame:
    """Rows as JSON text in one column `value`, the layout a Kafka producer takes."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def encode_messages(messages: DataFrame) -> DataFrame:
    """Messages as JSON text, with the translation (raw JSON text in a column) put back as an object."""
    plain = [c for c in messages.columns if c != "translation"]
    if "translation" not in messages.columns:
        return to_json_value(messages)
    translation = F.from_json("translation", "struct<service:string,text:array<string>>").alias("translation")
    return to_json_value(messages.select(*[F.col(f"`{c}`") for c in plain], translation))


def attach_translation(messages: DataFrame, translations: DataFrame) -> DataFrame:
    """Left join of messages with translations on (channel, id).

    `translations` holds channel, id, service and text (array of lines); the
    result's `translation` is the JSON text of service and lines, null when there
    is none. Copies of a translation are reduced to one before the join, which uses
    the same partitioning.
    """
    packed = one_per_key(translations.select("channel", "id", "service", "text"), ["channel", "id"])
    packed = packed.select("channel", "id", F.to_json(F.struct("service", "text")).alias("translation"))
    return messages.drop("translation").join(packed, ["channel", "id"], "left")
