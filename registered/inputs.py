"""Inputs of the registered queries, derived from the given tables by Spark, with the same derivation as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.functions import text, whois
from msgflow.operators.lookup import Lookup
from msgflow.session import spread


TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(rows) if name in TEXT_TABLES else rows


def large(lookup: Lookup, label: str) -> Lookup:
    """A lookup treated as one beyond broadcast size: in buckets of its key."""
    return Lookup(lookup.rows, lookup.key, False).staged(label)


def day_text(n: Column) -> Column:
    return F.concat(F.lit("2024-01-"), F.lpad((F.pmod(n, F.lit(28)) + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z"))


def document_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a message of its source channel, with its lines as text parts."""
    lines = F.split("text", "\n")
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        day_text(F.col("doc_id")).alias("data"),
        F.col("source").alias("channel"),
        lines.alias("text"),
        F.to_json(F.struct(F.lit("google").alias("service"), lines.alias("text"))).alias("translation"),
        day_text(F.col("doc_id")).alias("@timestamp"),
    )


DOCUMENT_MESSAGES_SQL = """
  SELECT CAST(doc_id AS VARCHAR) AS id, source AS channel, string_split(text, chr(10)) AS text,
         '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS ts
  FROM documents"""


def linked_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation turn as a message whose last text part cites a page.

    All pages are cited in turn: as they are, without protocol, at the end of a
    sentence, and every fourth link is to a page that was never crawled.
    """
    pages = table(spark, sf, "pages").select("page_id", "url")
    number = F.col("conv_id") * 8 + F.col("turn")
    conversations = table(spark, sf, "conversations").withColumn(
        "page_id", F.pmod(number, pages.agg(F.count("*")).scalar())
    )
    link = (
        F.when(F.col("turn") % 4 == 0, F.col("url"))
        .when(F.col("turn") % 4 == 1, F.regexp_replace("url", "^https?://", ""))
        .when(F.col("turn") % 4 == 2, F.concat(F.col("url"), F.lit(".")))
        .otherwise(F.concat(F.lit("https://nowhere"), (F.col("conv_id") % 7).cast("string"), F.lit(".absent-site.net/x")))
    )
    lines = F.split("text", "\n")
    return conversations.join(pages, "page_id").select(
        number.cast("string").alias("id"),
        day_text(F.col("conv_id")).alias("data"),
        F.col("role").alias("channel"),
        F.concat(lines, F.array(F.concat(F.lit("see "), link, F.lit(" now")))).alias("text"),
        F.to_json(F.struct(F.lit("deepl").alias("service"), lines.alias("text"))).alias("translation"),
        day_text(F.col("conv_id")).alias("@timestamp"),
    )


LINKED_MESSAGES_SQL = """
  SELECT CAST(conv_id * 8 + turn AS VARCHAR) AS id, role AS channel,
         '2024-01-' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS ts,
         list_append(string_split(c.text, chr(10)), 'see ' || CASE turn % 4
           WHEN 0 THEN url
           WHEN 1 THEN regexp_replace(url, '^https?://', '')
           WHEN 2 THEN url || '.'
           ELSE 'https://nowhere' || CAST(conv_id % 7 AS VARCHAR) || '.absent-site.net/x' END || ' now') AS text,
         to_json(string_split(c.text, chr(10)))::VARCHAR AS translated
  FROM conversations c JOIN pages p ON p.page_id = (conv_id * 8 + turn) % (SELECT count(*) FROM pages)"""


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """One registration per registered domain of the pages."""
    facts = (
        table(spark, sf, "pages")
        .groupBy(whois.registered_domain(F.col("url")).alias("domain"))
        .agg(F.count("*").alias("n"), F.min("page_id").alias("lo"), F.max("page_id").alias("hi"))
    )
    domain = F.col("domain")

    def date(n: Column) -> Column:
        return F.date_add(F.lit("2000-01-01").cast("date"), n.cast("int")).cast("timestamp")

    return facts.select(
        "domain",
        F.when(F.col("n") % 2 == 0, F.array(F.upper(domain), domain)).otherwise(F.array(F.upper(domain))).alias("domain_name"),
        F.concat(F.lit("whois."), domain).alias("whois_server"),
        F.concat(F.lit('Registrar "'), F.col("n").cast("string"), F.lit('"')).alias("registrar"),
        F.when(F.col("lo") % 2 == 0, F.lit("Org\\Unit")).alias("org"),
        F.lit(None).cast("string").alias("referral_url"),
        F.concat(F.lit("S"), F.col("lo").cast("string")).alias("state"),
        F.lit("Città").alias("city"),
        F.lit("IT").alias("country"),
        F.array(date(F.col("lo"))).alias("creation_date"),
        F.array(date(F.col("lo")), date(F.col("hi"))).alias("updated_date"),
        F.lit(None).cast("array<timestamp>").alias("expiration_date"),
    )


def gazetteer_raw(spark: SparkSession, sf: str) -> DataFrame:
    """City rows made of the benchmark passages: every place-length word, with a location text."""
    words = table(spark, sf, "benchmark").select(
        "item_id", F.posexplode(text.place_tokens(text.clean_text(F.col("text")))).alias("i", "w")
    )
    latitude = F.concat((F.pmod("item_id", F.lit(10)) + 40).cast("string"), F.lit("."), F.lpad(F.pmod("i", F.lit(100)).cast("string"), 2, "0"))
    longitude = F.concat((F.pmod("item_id", F.lit(7)) + 22).cast("string"), F.lit("."), F.lpad((F.pmod("i", F.lit(10)) * 10).cast("string"), 2, "0"))
    return words.select(
        (F.col("item_id") * 10000 + F.col("i")).alias("pos"),
        F.concat(F.upper(F.substring("w", 1, 1)), F.expr("substring(w, 2)")).alias("name"),
        (F.length("w") * 1000 + F.col("item_id")).cast("bigint").alias("population"),
        F.concat(F.lit("{'__type': 'GeoPoint', 'latitude': "), latitude, F.lit(", 'longitude': "), longitude, F.lit("}")).alias("location"),
        (F.col("item_id") * 10000 + F.col("i")).alias("cityId"),
    )


def gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    from msgflow.sources.tables import normalise_gazetteer

    return normalise_gazetteer(gazetteer_raw(spark, sf))


def channel_pages(spark: SparkSession, sf: str, per_page: int = 5) -> DataFrame:
    """Conversations rendered as channel pages of `per_page` messages at most.

    A channel is a conversation; pages are cut by turn, so that a long one becomes
    many pages. The last container of a page has no valid id.
    """
    from msgflow.operators.pages import render_container

    turns = table(spark, sf, "conversations")
    channel = F.concat(F.lit("ch"), F.col("conv_id").cast("string"))
    even = F.col("turn") % 2 == 0
    link = F.concat(F.lit("https://cdn.example.org/i?a=1&b="), F.col("turn").cast("string"))
    none = F.array().cast("array<string>")
    message = {
        "channel": channel,
        "id": (F.col("turn") + 1).cast("string"),
        "authorName": F.concat(F.lit("A & "), F.col("role")),
        "authorLink": F.concat(F.lit("https://t.me/"), channel),
        "text": F.split("text", "\n"),
        "images": F.when(even, F.array(link, F.concat(link, F.lit("x")))).otherwise(none),
        "videos": F.when(~even, F.array(link)).otherwise(none),
        "views": F.concat((F.col("turn") * 3).cast("string"), F.lit("K")),
        "data": day_text(F.col("conv_id")),
    }
    rendered = turns.select(
        channel.alias("channel"), F.floor(F.col("turn") / per_page).alias("page"), "turn", render_container(message).alias("box")
    )
    boxes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "box"))), lambda b: b["box"]), "\n")
    broken = '<div class="tgme_widget_message_wrap js-widget_message_wrap"><div class="tgme_widget_message" data-post="x/none"></div></div>'
    return rendered.groupBy("channel", "page").agg(
        F.concat(F.lit("<html><body><section>"), boxes, F.lit(broken), F.lit("</section></body></html>")).alias("html")
    ).select("channel", F.concat(F.lit("https://t.me/s/"), "channel", F.lit("?page="), F.col("page").cast("string")).alias("url"), "html")


CHANNEL_MESSAGES_SQL = """
  SELECT 'ch' || CAST(conv_id AS VARCHAR) AS channel, CAST(turn + 1 AS VARCHAR) AS id,
         '2024-01-' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS data,
         'A & ' || role AS author_name, 'https://t.me/ch' || CAST(conv_id AS VARCHAR) AS author_link,
         list_filter(string_split(text, chr(10)), lambda p: p <> '' AND p <> ' ') AS parts,
         'https://cdn.example.org/i?a=1&b=' || CAST(turn AS VARCHAR) AS link,
         CAST(turn * 3 AS VARCHAR) || 'K' AS views, conv_id, turn, turn // 5 AS page
  FROM conversations"""


def channel_options(spark: SparkSession, sf: str) -> DataFrame:
    """Channel overrides: one channel per conversation, some options set on some of them."""
    conversations = table(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    n = F.col("conv_id")
    return conversations.select(
        F.concat(F.lit("ch"), n.cast("string")).alias("channel"),
        F.when(n % 2 == 0, F.lit("2")).alias("last_id"),
        F.when(n % 3 == 0, F.when(n % 2 == 0, "FALSE").otherwise("yes")).alias("overwrite_last_id"),
        F.when(n % 5 == 0, F.lit("True")).alias("translation"),
        F.when(n % 4 == 0, F.lit("the la")).alias("query"),
        F.when(n % 7 == 0, F.col("n").cast("string")).alias("delay"),
    )


CHANNEL_CONFIG_SQL = """
  SELECT 'ch' || CAST(conv_id AS VARCHAR) AS channel,
         CASE WHEN conv_id % 2 = 0 THEN '2' ELSE '1' END AS last_id,
         CASE WHEN conv_id % 3 = 0 THEN CASE WHEN conv_id % 2 = 0 THEN 'FALSE' ELSE 'yes' END ELSE 'True' END AS overwrite_last_id,
         'all' AS method, 'True' AS batch,
         CASE WHEN conv_id % 7 = 0 THEN CAST(count(*) AS VARCHAR) ELSE '35' END AS delay,
         'None' AS to_file, 'False' AS stdout, 'True' AS sendtcp,
         CASE WHEN conv_id % 5 = 0 THEN 'True' ELSE 'False' END AS translation,
         'uk' AS translate_from, 'en' AS translate_to,
         CASE WHEN conv_id % 4 = 0 THEN 'the la' ELSE 'None' END AS query, '0' AS transaction_id, conv_id
  FROM conversations GROUP BY conv_id"""


def ingest_state(spark: SparkSession, sf: str) -> DataFrame:
    """Stored state: channels of even conversations have seen their first half."""
    return (
        table(spark, sf, "conversations")
        .where(F.col("conv_id") % 2 == 0)
        .groupBy("conv_id")
        .agg(F.count("*").alias("n"))
        .select(
            F.concat(F.lit("ch"), F.col("conv_id").cast("string")).alias("channel"),
            F.floor(F.col("n") / 2).alias("last_id"),
            F.when(F.col("conv_id") % 4 == 0, F.lit(9999)).otherwise(F.col("conv_id") % 100).cast("bigint").alias("transaction_id"),
        )
    )


INGEST_STATE_SQL = """
  SELECT 'ch' || CAST(conv_id AS VARCHAR) AS channel, CAST(floor(count(*) / 2) AS BIGINT) AS last_id,
         CAST(CASE WHEN conv_id % 4 = 0 THEN 9999 ELSE conv_id % 100 END AS BIGINT) AS transaction_id
  FROM conversations WHERE conv_id % 2 = 0 GROUP BY conv_id"""


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents: id, cleaned content, label (quality)."""
    return (
        table(spark, sf, "documents")
        .join(table(spark, sf, "labels"), "doc_id")
        .select("doc_id", text.clean_text(F.col("text")).alias("content"), F.col("quality").alias("label"))
    )
