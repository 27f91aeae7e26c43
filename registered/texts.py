"""Registered queries over texts, links and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgflow.functions import records, text, whois
from msgflow.operators import domains, enrich
from msgflow.plans.enrichment import LinkLookups, cited_urls, link_intelligence, link_lookups
from registered import inputs, sql
from registered.inputs import table

# A word character outside ASCII stands where `\b` and `\w` of the link pattern must
# see one; the SQL engine's classes are ASCII, so such letters are shown to it as Z.
_ASCII_VIEW = "regexp_replace({x}, '[^\\x00-\\x7F]', 'Z', 'g')"


def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clean_text(F.col("text")).alias("content"))


def letters_only(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.letters_only(F.col("text")).alias("letters"))


def tokenise(spark, sf):
    words = text.tokens(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.size(words).cast("bigint").alias("n_tokens"), F.array_join(words, "|").alias("tokens")
    )


def place_tokens(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(text.place_tokens(F.col("text"))).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("n"))


def extract_urls(spark, sf):
    found = F.posexplode(text.extract_urls(F.col("text"))).alias("pos", "url")
    documents = table(spark, sf, "documents").select("doc_id", found)
    return documents.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "url")


def extract_urls_markup(spark, sf):
    found = table(spark, sf, "pages").select("page_id", F.posexplode(text.extract_links(F.col("html"))).alias("pos", "link"))
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "link")


def ensure_protocol(spark, sf):
    url = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", "^https?://", "")).otherwise(F.col("url"))
    return table(spark, sf, "pages").select("page_id", text.ensure_protocol(url).alias("url"))


def explode_sentences(spark, sf):
    rows = enrich.explode_sentences(inputs.document_messages(spark, sf))
    return rows.select("id", "channel", F.col("`@timestamp`").alias("timestamp"), "sentence")


def text_parts(spark, sf):
    kept = text.keep_parts(F.split("text", "[\n ]"))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.size(kept).cast("bigint").alias("parts"),
        text.join_parts(kept).alias("joined"),
        F.size(text.split_parts(F.col("text"))).cast("bigint").alias("lines"),
    )


def visible_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.visible_text(F.col("html")).alias("visible"))


def visible_text_nested(spark, sf):
    """Pages with an element inside the head, between texts of the head itself, and at the end a title that is never closed, with an element in it."""
    number = F.col("page_id").cast("string")
    inner = F.concat(F.lit("<head>lost<noscript>seen "), number, F.lit("</noscript>lost"))
    html = F.concat(F.replace("html", F.lit("<head>"), inner), F.lit("<title>lost<i>kept "), number, F.lit("</i>lost"))
    return table(spark, sf, "pages").select("page_id", text.visible_text(html).alias("visible"))


def page_text(spark, sf):
    """Page text as the link query uses it: visible, then cleaned."""
    return table(spark, sf, "pages").select("page_id", text.clean_text(text.visible_text(F.col("html"))).alias("content"))


def page_domains(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", whois.host_of(url).alias("host"), whois.registered_domain(url).alias("domain"), records.page_key(url).alias("page_key")
    )


def page_domains_by_rules(spark, sf):
    """Domains by suffix rules of all kinds, made of the pages' own hosts: a top label, a longer suffix, a wildcard and exceptions to it."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    host = whois.host_of(F.col("url"))
    top, two, three = (F.substring_index(host, ".", -k) for k in (1, 2, 3))
    rules = F.array(
        top, F.when(top == "org", two), F.when(top == "net", F.concat(F.lit("*."), two)),
        F.when((top == "net") & F.startswith(three, F.lit("t")), F.concat(F.lit("!"), three)), F.lit("// a comment"),
    )
    lines = pages.select(F.explode(rules).alias("value")).where("value IS NOT NULL").distinct()
    return domains.with_domain(pages, domains.suffix_rules(lines)).drop("url")


def explode_urls(spark, sf):
    return cited_urls(inputs.linked_messages(spark, sf)).withColumnRenamed("@timestamp", "timestamp")


def enrich_pages(spark, sf):
    urls = cited_urls(inputs.linked_messages(spark, sf)).withColumnRenamed("@timestamp", "timestamp")
    return enrich.enrich_pages(urls, table(spark, sf, "pages"))


def enrich_whois(spark, sf):
    urls = cited_urls(inputs.linked_messages(spark, sf)).withColumnRenamed("@timestamp", "timestamp")
    return enrich.enrich_whois(urls, inputs.registry(spark, sf), as_json=False)


def enrich_pages_large(spark, sf):
    urls = cited_urls(inputs.linked_messages(spark, sf)).withColumnRenamed("@timestamp", "timestamp")
    return enrich.enrich_pages(urls, inputs.large(enrich.page_lookup(table(spark, sf, "pages")), "page-contents"))


def enrich_whois_large(spark, sf):
    urls = cited_urls(inputs.linked_messages(spark, sf)).withColumnRenamed("@timestamp", "timestamp")
    return enrich.enrich_whois(urls, inputs.large(enrich.whois_lookup(inputs.registry(spark, sf)), "registrations"), as_json=False)


def whois_json(spark, sf):
    urls = table(spark, sf, "pages").select("page_id", "url")
    return enrich.enrich_whois(urls, inputs.registry(spark, sf)).select("page_id", "whois")


def links_unscored(spark, sf):
    lookups = link_lookups(table(spark, sf, "pages"), inputs.registry(spark, sf))
    out = link_intelligence(inputs.linked_messages(spark, sf), lookups)
    return out.withColumnRenamed("@timestamp", "timestamp")


def links_unscored_large(spark, sf):
    """The link query with both lookups in buckets of their keys."""
    lookups = link_lookups(table(spark, sf, "pages"), inputs.registry(spark, sf))
    lookups = LinkLookups(inputs.large(lookups.pages, "page-contents"), inputs.large(lookups.registry, "registrations"), None)
    return link_intelligence(inputs.linked_messages(spark, sf), lookups).withColumnRenamed("@timestamp", "timestamp")


QUERIES = {
    "clean_text": clean_text,
    "letters_only": letters_only,
    "tokenise": tokenise,
    "place_tokens": place_tokens,
    "extract_urls": extract_urls,
    "extract_urls_markup": extract_urls_markup,
    "ensure_protocol": ensure_protocol,
    "explode_sentences": explode_sentences,
    "text_parts": text_parts,
    "visible_text": visible_text,
    "visible_text_nested": visible_text_nested,
    "page_text": page_text,
    "page_domains": page_domains,
    "page_domains_by_rules": page_domains_by_rules,
    "explode_urls": explode_urls,
    "enrich_pages": enrich_pages,
    "enrich_whois": enrich_whois,
    "enrich_pages_large": enrich_pages_large,
    "enrich_whois_large": enrich_whois_large,
    "whois_json": whois_json,
    "link_intelligence": links_unscored,
    "link_intelligence_large": links_unscored_large,
}

_HOST = "lower(regexp_extract(url, '^(?:https?://)?([^/:?#]+)', 1))"
CITED_URLS_SQL = f"""
  SELECT id, channel, timestamp, {sql.protocol('link')} AS url
  FROM (SELECT id, channel, ts AS timestamp, unnest({sql.links(_ASCII_VIEW.format(x='sentence'))}) AS link
        FROM (SELECT id, channel, ts, unnest(text) AS sentence FROM ({inputs.LINKED_MESSAGES_SQL})))"""

PAGE_CONTENTS_SQL = f"""
  SELECT page_key, {sql.clean(sql.visible('html'))} AS content
  FROM (SELECT {sql.page_key('url')} AS page_key, html,
               row_number() OVER (PARTITION BY {sql.page_key('url')} ORDER BY page_id) AS r FROM pages) WHERE r = 1"""

REGISTRY_SQL = f"""
  SELECT {sql.domain('url')} AS domain, count(*) AS n, min(page_id) AS lo, max(page_id) AS hi FROM pages GROUP BY 1"""

_MIN = "'0001-01-01 00:00:00'"
WHOIS_VALUES = {
    "domain_name": "CASE WHEN n % 2 = 0 THEN domain WHEN domain IS NOT NULL THEN upper(domain) ELSE 'None' END",
    "whois_server": "coalesce('whois.' || domain, 'None')",
    "registrar": "coalesce('Registrar \"' || CAST(n AS VARCHAR) || '\"', 'None')",
    "org": "CASE WHEN lo % 2 = 0 THEN 'Org\\Unit' ELSE 'None' END",
    "referral_url": "'None'",
    "state": "coalesce('S' || CAST(lo AS VARCHAR), 'None')",
    "city": "CASE WHEN domain IS NULL THEN 'None' ELSE 'Città' END",
    "country": "CASE WHEN domain IS NULL THEN 'None' ELSE 'IT' END",
    "creation_date": f"coalesce(strftime(DATE '2000-01-01' + CAST(lo AS INTEGER), '%Y-%m-%d 00:00:00'), {_MIN})",
    "updated_date": _MIN,
    "expiration_date": _MIN,
}


def _escaped(value: str) -> str:
    return f"replace(replace({value}, '\\', '\\\\'), '\"', '\\\"')"


WHOIS_JSON_SQL = (
    "'{' || chr(10) || "
    + " || ',' || chr(10) || ".join(f"'    \"{name}\": \"' || {_escaped(value)} || '\"'" for name, value in WHOIS_VALUES.items())
    + " || chr(10) || '}'"
)

LINKS_SQL = f"""
  SELECT u.id, u.channel, u.timestamp, coalesce(p.content, 'null') AS content, u.url, {WHOIS_JSON_SQL} AS whois
  FROM ({CITED_URLS_SQL}) u LEFT JOIN ({PAGE_CONTENTS_SQL}) p ON p.page_key = {sql.page_key('u.url')}
  LEFT JOIN ({REGISTRY_SQL}) r ON r.domain = {sql.domain('u.url')}"""

SQL = {
    "clean_text": f"SELECT doc_id, {sql.clean('text')} AS content FROM documents",
    "letters_only": f"SELECT doc_id, {sql.letters('text')} AS letters FROM documents",
    "tokenise": f"""SELECT doc_id, len(t) AS n_tokens, array_to_string(t, '|') AS tokens
        FROM (SELECT doc_id, list_filter({sql.words('text')}, lambda w: w <> '') AS t FROM documents)""",
    "place_tokens": f"SELECT token, count(*) AS n FROM (SELECT unnest({sql.place_words('text')}) AS token FROM documents) GROUP BY token",
    "extract_urls": f"""SELECT doc_id, i - 1 AS pos, {sql.protocol('link')} AS url
        FROM (SELECT doc_id, unnest(l) AS link, generate_subscripts(l, 1) AS i
              FROM (SELECT doc_id, {sql.links(_ASCII_VIEW.format(x='text'))} AS l FROM documents))""",
    "extract_urls_markup": f"""SELECT page_id, unnest(range(len(l))) AS pos, unnest(l) AS link
        FROM (SELECT page_id, {sql.links(_ASCII_VIEW.format(x='html'))} AS l FROM pages)""",
    "ensure_protocol": f"""SELECT page_id, {sql.protocol('u')} AS url
        FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_replace(url, '^https?://', '') ELSE url END AS u FROM pages)""",
    "explode_sentences": f"SELECT id, channel, ts AS timestamp, unnest(text) AS sentence FROM ({inputs.DOCUMENT_MESSAGES_SQL})",
    "text_parts": """SELECT conv_id, turn, len(k) AS parts, array_to_string(k, chr(10)) AS joined, lines
        FROM (SELECT conv_id, turn, list_filter(string_split_regex(text, '[\\n ]'), lambda p: p <> '' AND p <> ' ') AS k,
                     len(string_split(text, chr(10))) AS lines FROM conversations)""",
    "visible_text": f"SELECT page_id, {sql.visible('html')} AS visible FROM pages",
    "page_text": f"SELECT page_id, {sql.clean(sql.visible('html'))} AS content FROM pages",
    "page_domains": f"SELECT page_id, {_HOST} AS host, {sql.domain('url')} AS domain, {sql.page_key('url')} AS page_key FROM pages",
    "explode_urls": CITED_URLS_SQL,
    "enrich_pages": f"""SELECT u.id, u.channel, u.timestamp, u.url, coalesce(p.content, 'null') AS content
        FROM ({CITED_URLS_SQL}) u LEFT JOIN ({PAGE_CONTENTS_SQL}) p ON p.page_key = {sql.page_key('u.url')}""",
    "enrich_whois": f"""SELECT u.id, u.channel, u.timestamp, u.url,
        {', '.join(f'{value} AS whois_{name}' for name, value in WHOIS_VALUES.items())}
        FROM ({CITED_URLS_SQL}) u LEFT JOIN ({REGISTRY_SQL}) r ON r.domain = {sql.domain('u.url')}""",
    "whois_json": f"""SELECT p.page_id, {WHOIS_JSON_SQL} AS whois
        FROM pages p LEFT JOIN ({REGISTRY_SQL}) r ON r.domain = {sql.domain('p.url')}""",
    "link_intelligence": LINKS_SQL,
}
SQL["enrich_pages_large"], SQL["enrich_whois_large"] = SQL["enrich_pages"], SQL["enrich_whois"]
SQL["page_domains_by_rules"] = f"""
  SELECT page_id, array_to_string(list_slice(labels, -least(len(labels), CASE labels[-1] WHEN 'org' THEN 3
           WHEN 'net' THEN CASE WHEN starts_with(labels[-3], 't') THEN 3 ELSE 4 END ELSE 2 END), -1), '.') AS domain
  FROM (SELECT page_id, string_split({_HOST}, '.') AS labels FROM pages)"""
SQL["visible_text_nested"] = f"""
  SELECT page_id, 'seen ' || page_id || ' ' || CASE WHEN v = '' THEN '' ELSE v || ' ' END || 'kept ' || page_id AS visible
  FROM (SELECT page_id, {sql.visible('html')} AS v FROM pages)"""
SQL["link_intelligence_large"] = LINKS_SQL
