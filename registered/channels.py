"""Registered queries over channel pages, options, ingest state and service routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgflow.fixed_values import SERVICE_CATALOG, SPLIT_SEED
from msgflow.functions import records
from msgflow.operators import pages as channel_pages
from msgflow.operators import routing, skew, state
from msgflow.plans.preparation import ingest_channels, translation_requests
from msgflow.sources import tables
from msgflow.sources.messages import attach_translation
from registered import inputs
from registered.inputs import table


def _flat(messages):
    """Arrays as text, so that results compare as plain values."""
    joined = lambda c: F.array_join(F.col(c), "|").alias(c)
    return messages.select("channel", "id", "data", "authorName", "authorLink", joined("images"), joined("text"), joined("videos"), "views")


def parse_pages(spark, sf):
    return _flat(channel_pages.parse_channel_pages(inputs.channel_pages(spark, sf)))


def page_summary(spark, sf):
    summary = channel_pages.page_summary(inputs.channel_pages(spark, sf))
    return summary.select("channel", "url", "messages", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"), "max_id")


def relevant_classes(spark, sf):
    boxes = inputs.channel_pages(spark, sf).select(F.explode(channel_pages.containers(F.col("html"))).alias("box"))
    classes = boxes.select(F.explode(channel_pages.relevant_classes(F.col("box"))).alias("class"))
    return classes.groupBy("class").agg(F.count("*").alias("n"))


def _numbered(spark, sf):
    """Messages whose id is a number, a negative number or no number at all."""
    number = F.col("doc_id")
    text_id = F.when(number % 7 == 0, F.concat(F.lit("x"), number.cast("string"))).when(number % 5 == 0, (-number).cast("string")).otherwise(number.cast("string"))
    return table(spark, sf, "documents").select("doc_id", text_id.alias("id"), F.split("text", "\n").alias("text"))


def valid_ids(spark, sf):
    return state.valid_messages(_numbered(spark, sf)).select("doc_id", "id")


def id_range(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", F.col("turn").cast("string").alias("id"))
    return state.between_ids(turns, min_id=0, max_id=5)


def keyword_query(spark, sf):
    return state.matching_query(_numbered(spark, sf), "The Of").select("doc_id")


def message_ids(spark, sf):
    post = F.concat(F.lit("channel/"), F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("9/"), F.col("page_id").cast("string"))).otherwise(F.col("page_id").cast("string")))
    return table(spark, sf, "pages").select("page_id", records.message_id(post).alias("id"))


def channel_addresses(spark, sf):
    n, source = F.col("doc_id") % 5, F.col("source")
    address = (
        F.when(n == 0, F.concat(F.lit("t.me/"), source))
        .when(n == 1, F.concat(F.lit("https://t.me/s/"), source))
        .when(n == 2, F.concat(F.lit("https://t.me/"), source))
        .when(n == 3, F.concat(F.lit("t.me/s/"), source))
        .otherwise(F.concat(F.lit("x.org/"), source))
    )
    url = records.channel_url(address)
    return table(spark, sf, "documents").select("doc_id", url.alias("url"), records.channel_name(url).alias("name"))


def channel_config(spark, sf):
    return tables.resolve_channel_config(inputs.channel_options(spark, sf))


def option_values(spark, sf):
    config = tables.resolve_channel_config(inputs.channel_options(spark, sf))
    return config.select(
        "channel",
        records.option_flag(F.col("overwrite_last_id")).cast("string").alias("overwrite"),
        records.option_flag(F.col("translation")).cast("string").alias("translate"),
        records.option_text(F.col("query")).alias("query"),
        records.option_text(F.col("to_file")).alias("to_file"),
    )


def merged_state(spark, sf):
    config = tables.resolve_channel_config(inputs.channel_options(spark, sf))
    return state.merge_state(config, inputs.ingest_state(spark, sf)).select("channel", "last_id", "transaction_id")


def crawl_frontier(spark, sf):
    config = tables.resolve_channel_config(inputs.channel_options(spark, sf))
    return state.crawl_frontier(config, inputs.ingest_state(spark, sf))


def ingest_increment(spark, sf):
    messages = channel_pages.parse_channel_pages(inputs.channel_pages(spark, sf))
    return state.ingest_increment(messages, inputs.ingest_state(spark, sf)).select("channel", "id")


def advance_state(spark, sf):
    messages = channel_pages.parse_channel_pages(inputs.channel_pages(spark, sf))
    before = inputs.ingest_state(spark, sf)
    return state.advance_state(before, state.ingest_increment(messages, before))


def ingest(spark, sf):
    """Pages, state, options and translations to new messages."""
    translations = table(spark, sf, "conversations").where(F.col("turn") % 3 == 0).select(
        F.concat(F.lit("ch"), F.col("conv_id").cast("string")).alias("channel"),
        (F.col("turn") + 1).cast("string").alias("id"),
        F.lit("bing").alias("service"),
        F.split("text", "\n").alias("text"),
    )
    found = ingest_channels(
        inputs.channel_pages(spark, sf), inputs.ingest_state(spark, sf), translations,
        tables.resolve_channel_config(inputs.channel_options(spark, sf)),
    )
    return found.select("channel", "id", F.array_join("text", "|").alias("text"), F.get_json_object("translation", "$.service").alias("service"))


def requests(spark, sf):
    messages = channel_pages.parse_channel_pages(inputs.channel_pages(spark, sf))
    config = tables.resolve_channel_config(inputs.channel_options(spark, sf))
    return translation_requests(messages, config, tables.service_catalog(spark))


def starting_state(spark, sf):
    config = tables.resolve_channel_config(inputs.channel_options(spark, sf))
    return state.starting_state(config, inputs.ingest_state(spark, sf)).select("channel", "last_id")


def translations_attached(spark, sf):
    messages = inputs.document_messages(spark, sf).drop("translation")
    translations = messages.where(F.col("id").cast("bigint") % 2 == 0).select("channel", "id", F.lit("deepl").alias("service"), "text")
    return attach_translation(messages, translations).select("id", "channel", F.coalesce("translation", F.lit("none")).alias("translation"))


def _language(spark, sf):
    """Documents with the languages a translation to English needs; some need one nobody knows, some none."""
    code = F.when(F.col("doc_id") % 11 == 0, "ch").when(F.col("doc_id") % 3 == 0, "uk").otherwise(F.col("lang"))
    target = F.when(F.col("doc_id") % 13 == 0, "xx").otherwise("en")
    return table(spark, sf, "documents").withColumns({
        "required": routing.required_languages(code, target),
        "ignored": routing.unknown_languages(code, target),
    })


def required_languages(spark, sf):
    return _language(spark, sf).select(
        "doc_id", F.array_join("required", ",").alias("required"), F.array_join("ignored", ",").alias("ignored")
    )


def eligible_services(spark, sf):
    catalog = tables.service_catalog(spark)
    services = routing.eligible_services(_language(spark, sf), catalog)
    return services.select(F.array_join("required", ",").alias("required"), "pos", "service", "vote")


def route_weighted(spark, sf):
    routed = routing.route_weighted(_language(spark, sf), tables.service_catalog(spark), "doc_id")
    return routed.select("doc_id", F.coalesce("service", F.lit("none")).alias("service"))


def route_hashed(spark, sf):
    routed = routing.route_weighted(_language(spark, sf), tables.service_catalog(spark), "doc_id", seed=7)
    return routed.select("doc_id", F.coalesce("service", F.lit("none")).alias("service"))


def _source_services(spark, sf):
    """A catalog drawn from the documents: per language, one service per source, with its documents as votes."""
    counts = table(spark, sf, "documents").groupBy("lang", "source").agg(F.count("*").alias("vote"))
    return counts.select("lang", F.regexp_extract("source", "[0-9]+", 0).cast("bigint").alias("pos"), F.col("source").alias("service"), "vote")


def cumulative_votes(spark, sf):
    return routing.cumulative_votes(_source_services(spark, sf), "lang").select("lang", "service", "vote", "lo", "hi")


def total_votes(spark, sf):
    return routing.total_votes(_source_services(spark, sf))


def running_total(spark, sf):
    """Running number of characters over all documents, in id order."""
    return skew.running_total(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", "running", block=1000)


def parse_catalog(spark, sf):
    """Catalog lines written out of the documents (service, vote, languages) and parsed."""
    line = F.concat_ws("  ", F.lit(" "), "source", F.col("n_chars").cast("string"), "lang", F.when(F.col("doc_id") % 2 == 0, "auto"), F.lit(" "))
    parsed = tables.parse_catalog(table(spark, sf, "documents").select("doc_id", line.alias("value")))
    return parsed.select("doc_id", "service", "vote", F.array_join("langs", ",").alias("langs"))


def parse_pages_nested(spark, sf):
    """Messages whose markup is written out here: elements in elements, some never closed, attributes that hold marks, and a shape of its own per turn."""
    turn, word = F.col("turn").cast("string"), F.concat(F.col("role"), F.col("turn").cast("string"))
    bodies = [
        F.concat(F.lit("bare "), word, F.lit("<b>bold <i>in <u>"), word, F.lit("</u></i></b> tail<br/>end")),
        F.concat(F.lit('<a href="https://x.org/?a=1&amp;b=2" title="1">link <b>never closed '), word, F.lit("</a>after")),
        F.concat(F.lit("<div>own <div>inner "), word, F.lit("</div></div></span>x &lt;y&gt;")),
        F.concat(F.lit("<i>open to the end "), word),
    ]
    body = F.when(F.col("turn") % 4 == 0, bodies[0]).when(F.col("turn") % 4 == 1, bodies[1]).when(F.col("turn") % 4 == 2, bodies[2]).otherwise(bodies[3])
    author = F.concat(F.lit('<div class="x tgme_widget_message_author y"><a href="https://t.me/'), word, F.lit('"><span>The <b>'), word, F.lit("</b> of <i>all</i></span></a></div>"))
    html = F.concat(
        F.lit('<html><body><div class="tgme_widget_message_wrap js-widget_message_wrap"><div data-x="1" class="tgme_widget_message z" data-post="c/'), turn, F.lit('">'),
        author, F.lit('<div class="tgme_widget_message_text js-message_text">'), body,
        F.lit('</div><span class="tgme_widget_message_views">1<b>2</b>K</span><a class="tgme_widget_message_date" href="#"><span><time class="t" datetime="'),
        F.lit("2024-05-06T07:08:09+00:00"), F.lit('"></time></span></a></div></div></body></html>'),
    )
    pages = table(spark, sf, "conversations").select(F.concat(F.lit("ch"), F.col("conv_id").cast("string")).alias("channel"), F.lit("u").alias("url"), html.alias("html"))
    found = channel_pages.parse_channel_pages(pages)
    return found.select("channel", "id", "data", "authorName", "authorLink", F.array_join("text", "|").alias("text"), "views")


QUERIES = {
    "parse_channel_pages": parse_pages,
    "parse_channel_pages_nested": parse_pages_nested,
    "page_summary": page_summary,
    "relevant_classes": relevant_classes,
    "valid_ids": valid_ids,
    "id_range": id_range,
    "keyword_query": keyword_query,
    "message_ids": message_ids,
    "channel_addresses": channel_addresses,
    "channel_config": channel_config,
    "option_values": option_values,
    "merge_state": merged_state,
    "crawl_frontier": crawl_frontier,
    "ingest_increment": ingest_increment,
    "advance_state": advance_state,
    "starting_state": starting_state,
    "ingest_channels": ingest,
    "translation_requests": requests,
    "attach_translation": translations_attached,
    "required_languages": required_languages,
    "eligible_services": eligible_services,
    "route_weighted": route_weighted,
    "route_hashed": route_hashed,
    "cumulative_votes": cumulative_votes,
    "total_votes": total_votes,
    "running_total": running_total,
    "parse_catalog": parse_catalog,
}

_MESSAGES = inputs.CHANNEL_MESSAGES_SQL
_NUMBERED = """SELECT doc_id, text, CASE WHEN doc_id % 7 = 0 THEN 'x' || CAST(doc_id AS VARCHAR)
    WHEN doc_id % 5 = 0 THEN CAST(-doc_id AS VARCHAR) ELSE CAST(doc_id AS VARCHAR) END AS id FROM documents"""
_NEW = f"""SELECT m.*, s.last_id, s.transaction_id FROM ({_MESSAGES}) m LEFT JOIN ({inputs.INGEST_STATE_SQL}) s ON s.channel = m.channel
    WHERE CAST(m.id AS BIGINT) > coalesce(s.last_id, -1)"""

_NEW_CONFIGURED = _NEW.replace("coalesce(s.last_id, -1)", "coalesce(s.last_id, 1)")
_SLOT = f"CAST('0x' || substr(md5('{SPLIT_SEED}:' || channel || '/' || id), 1, 8) AS BIGINT) % 40"

# Services that serve a document: those whose languages hold every required one.
_LINES = [line.split() for line in SERVICE_CATALOG.splitlines()]
_SERVICES = ", ".join(f"({pos}, '{line[0]}', {line[1]}, {line[2:]})" for pos, line in enumerate(_LINES))
_LANGUAGE = """SELECT doc_id, [code, target] AS languages,
    list_filter(['auto', 'en', 'ru', 'uk', 'it', 'de', 'ch'], lambda k: k = code OR k = target) AS required
    FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'ch' WHEN doc_id % 3 = 0 THEN 'uk' ELSE lang END AS code,
                 CASE WHEN doc_id % 13 = 0 THEN 'xx' ELSE 'en' END AS target FROM documents)"""
_CATALOG = f"SELECT * FROM (VALUES {_SERVICES}) AS v(pos, service, vote, langs)"
_RANGES = f"""SELECT required, service, vote, pos, sum(vote) OVER w - vote AS lo, sum(vote) OVER w AS hi, sum(vote) OVER (PARTITION BY required) AS total
    FROM (SELECT DISTINCT required FROM ({_LANGUAGE})) r JOIN ({_CATALOG}) c ON list_has_all(c.langs, r.required)
    WINDOW w AS (PARTITION BY required ORDER BY pos ROWS UNBOUNDED PRECEDING)"""


def _route_sql(number: str) -> str:
    return f"""SELECT l.doc_id, coalesce(r.service, 'none') AS service FROM ({_LANGUAGE}) l
        LEFT JOIN ({_RANGES}) r ON r.required = l.required AND {number} % nullif(r.total, 0) >= r.lo AND {number} % nullif(r.total, 0) < r.hi"""


_BY_SOURCE = """SELECT lang, CAST(regexp_extract(source, '[0-9]+') AS BIGINT) AS pos, source AS service, count(*) AS vote
    FROM documents GROUP BY lang, source"""

SQL = {
    "parse_channel_pages_nested": """SELECT 'ch' || conv_id AS channel, CAST(turn AS VARCHAR) AS id, '2024-05-06T07:08:09+00:00' AS data, 'The ' || w || ' of all' AS "authorName",
        'https://t.me/' || w AS "authorLink", CASE turn % 4
          WHEN 0 THEN 'bare ' || w || '|bold in ' || w || '| tail|end' WHEN 1 THEN 'link never closed ' || w || '|after'
          WHEN 2 THEN 'own inner ' || w || '|x <y>' ELSE 'open to the end ' || w END AS text, '12K' AS views
        FROM (SELECT *, role || turn AS w FROM conversations)""",
    "parse_channel_pages": f"""SELECT channel, id, data, author_name AS "authorName", author_link AS "authorLink",
        CASE WHEN turn % 2 = 0 THEN link || '|' || link || 'x' END AS images, array_to_string(parts, '|') AS text,
        CASE WHEN turn % 2 = 1 THEN link END AS videos, views FROM ({_MESSAGES})""",
    "page_summary": f"""SELECT channel, 'https://t.me/s/' || channel || '?page=' || CAST(page AS VARCHAR) AS url,
        count(*) + 1 AS messages, string_agg(id, ',' ORDER BY turn) AS ids, max(turn) + 1 AS max_id
        FROM ({_MESSAGES}) GROUP BY channel, page""",
    "relevant_classes": """SELECT 'tgme_widget_message_text' AS class, count(*) AS n FROM conversations
        UNION ALL SELECT 'tgme_widget_message_photo_wrap', count(*) FROM conversations WHERE turn % 2 = 0
        UNION ALL SELECT 'tgme_widget_message_video_wrap', count(*) FROM conversations WHERE turn % 2 = 1""",
    "valid_ids": f"SELECT doc_id, id FROM ({_NUMBERED}) WHERE try_cast(id AS BIGINT) >= 0",
    "id_range": "SELECT conv_id, CAST(turn AS VARCHAR) AS id FROM conversations WHERE turn > 0 AND turn <= 5",
    "keyword_query": "SELECT doc_id FROM documents WHERE contains(lower(text), 'the of')",
    "message_ids": """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '9/' ELSE '' END || CAST(page_id AS VARCHAR) AS id FROM pages""",
    "channel_addresses": """SELECT doc_id, CASE WHEN doc_id % 5 < 4 THEN 'https://t.me/s/' || source END AS url,
        CASE WHEN doc_id % 5 < 4 THEN source END AS name FROM documents""",
    "channel_config": f"SELECT * EXCLUDE (conv_id) FROM ({inputs.CHANNEL_CONFIG_SQL})",
    "option_values": f"""SELECT channel, CASE WHEN lower(overwrite_last_id) = 'false' THEN 'false' ELSE 'true' END AS overwrite,
        lower(translation) AS translate, CASE WHEN query <> 'None' THEN query END AS query, CAST(NULL AS VARCHAR) AS to_file
        FROM ({inputs.CHANNEL_CONFIG_SQL})""",
    "merge_state": f"""SELECT c.channel,
        CASE WHEN taken THEN CAST(greatest(s_last, CAST(last_id AS BIGINT)) AS VARCHAR) ELSE last_id END AS last_id,
        CASE WHEN taken THEN CAST(s_counter AS VARCHAR) ELSE transaction_id END AS transaction_id
        FROM (SELECT c.channel, c.last_id, c.transaction_id, s.last_id AS s_last, s.transaction_id AS s_counter,
                     lower(overwrite_last_id) <> 'false' AND s.transaction_id IS NOT NULL
                     AND CAST(s.transaction_id AS VARCHAR) <> c.transaction_id AS taken
              FROM ({inputs.CHANNEL_CONFIG_SQL}) c LEFT JOIN ({inputs.INGEST_STATE_SQL}) s ON s.channel = c.channel) c""",
    "crawl_frontier": f"""SELECT c.channel, 'https://t.me/s/' || c.channel ||
        CASE WHEN s.channel IS NULL THEN '/' || c.last_id || CASE WHEN query <> 'None' THEN '?q=the+la' ELSE '' END
             ELSE '?' || CASE WHEN query <> 'None' THEN 'q=the+la&' ELSE '' END || 'after=' || CAST(s.last_id AS VARCHAR) END AS next_url
        FROM ({inputs.CHANNEL_CONFIG_SQL}) c LEFT JOIN ({inputs.INGEST_STATE_SQL}) s ON s.channel = c.channel""",
    "ingest_increment": f"SELECT channel, id FROM ({_NEW})",
    "advance_state": f"""SELECT coalesce(n.channel, s.channel) AS channel, coalesce(greatest(n.hi, s.last_id), n.hi, s.last_id) AS last_id,
        CASE WHEN n.channel IS NULL THEN s.transaction_id ELSE coalesce((s.transaction_id + 1) % 10000, 1) END AS transaction_id
        FROM (SELECT channel, max(CAST(id AS BIGINT)) AS hi FROM ({_NEW}) GROUP BY channel) n
        FULL JOIN ({inputs.INGEST_STATE_SQL}) s ON s.channel = n.channel""",
    "ingest_channels": f"""SELECT channel, id, array_to_string(parts, '|') AS text,
        CASE WHEN conv_id % 5 = 0 AND turn % 3 = 0 THEN 'bing' END AS service
        FROM ({_NEW_CONFIGURED}) WHERE conv_id % 4 <> 0 OR contains(lower(array_to_string(parts, chr(10))), 'the la')""",
    "starting_state": f"""SELECT c.channel, coalesce(s.last_id, CAST(c.last_id AS BIGINT)) AS last_id
        FROM ({inputs.CHANNEL_CONFIG_SQL}) c LEFT JOIN ({inputs.INGEST_STATE_SQL}) s ON s.channel = c.channel""",
    "translation_requests": f"""SELECT channel, id, CASE WHEN {_SLOT} < 8 THEN 'google' WHEN {_SLOT} < 16 THEN 'bing' WHEN {_SLOT} < 23 THEN 'reverso'
        WHEN {_SLOT} < 32 THEN 'deepl' ELSE 'itranslate' END AS service, 'uk' AS source, 'en' AS target, array_to_string(parts, chr(10)) AS text
        FROM ({_MESSAGES}) WHERE conv_id % 5 = 0""",
    "attach_translation": """SELECT CAST(doc_id AS VARCHAR) AS id, source AS channel,
        CASE WHEN doc_id % 2 = 0 THEN '{"service":"deepl","text":' || to_json(string_split(text, chr(10)))::VARCHAR || '}' ELSE 'none' END AS translation
        FROM documents""",
    "required_languages": f"""SELECT doc_id, array_to_string(required, ',') AS required,
        array_to_string(list_filter(languages, lambda l: NOT list_contains(['auto', 'en', 'ru', 'uk', 'it', 'de', 'ch'], l)), ',') AS ignored
        FROM ({_LANGUAGE})""",
    "eligible_services": f"SELECT array_to_string(required, ',') AS required, CAST(pos AS BIGINT) AS pos, service, CAST(vote AS BIGINT) AS vote FROM ({_RANGES})",
    "route_weighted": _route_sql("l.doc_id"),
    "route_hashed": _route_sql("CAST('0x' || substr(md5('7:' || CAST(l.doc_id AS VARCHAR)), 1, 8) AS BIGINT)"),
    "cumulative_votes": f"""SELECT lang, service, vote, CAST(sum(vote) OVER w AS BIGINT) - vote AS lo, CAST(sum(vote) OVER w AS BIGINT) AS hi
        FROM ({_BY_SOURCE}) WINDOW w AS (PARTITION BY lang ORDER BY pos ROWS UNBOUNDED PRECEDING)""",
    "total_votes": "SELECT count(*) AS votes FROM documents",
    "running_total": "SELECT doc_id, n_chars, CAST(sum(n_chars) OVER (ORDER BY doc_id) AS BIGINT) AS running FROM documents",
    "parse_catalog": """SELECT doc_id, source AS service, n_chars AS vote, lang || CASE WHEN doc_id % 2 = 0 THEN ',auto' ELSE '' END AS langs FROM documents""",
}
