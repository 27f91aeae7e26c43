"""Registered queries over the gazetteer, cited places and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgflow.functions import geo, text
from msgflow.operators import analytics, enrich
from msgflow.plans.enrichment import message_analysis
from msgflow.plans.preparation import build_gazetteer
from msgflow.session import work_path
from msgflow.sources import sinks, tables
from msgflow.sources.messages import decode_translation
from registered import inputs, sql
from registered.inputs import table


def gazetteer_normalise(spark, sf):
    return inputs.gazetteer(spark, sf)


def gazetteer_lookup(spark, sf):
    return tables.gazetteer_lookup(inputs.gazetteer(spark, sf))


def gazetteer_first(spark, sf):
    cities = tables.first_cities(inputs.gazetteer_raw(spark, sf))
    return cities.select("pos", "name", "population", "cityId")


def gazetteer_build(spark, sf):
    """Documents of at most 500 cities each, written, read, normalised, written and read again."""
    cities = inputs.gazetteer_raw(spark, sf)
    document = F.struct("pos", "name", "population", "location", "cityId")
    bounded = cities.groupBy(F.floor(F.col("pos") / 500).alias("part")).agg(F.array_sort(F.collect_list(document)).alias("results"))
    path = work_path(spark, "city-documents")
    bounded.select("results").write.json(path)
    read = build_gazetteer(spark, path, work_path(spark, "gazetteer"), limit=None)
    return read.select("name", "population", "latitude", "longitude")


def gazetteer_documents_first(spark, sf):
    """The first 300 cities in source order, from many files of documents of at most 50 cities each."""
    cities = inputs.gazetteer_raw(spark, sf)
    document = F.struct("pos", "name", "population", "location", "cityId")
    bounded = cities.groupBy(F.floor(F.col("pos") / 50).alias("part")).agg(F.array_sort(F.collect_list(document)).alias("results"))
    path = work_path(spark, "city-documents")
    bounded.sort("part").select("results").write.json(path)
    return tables.first_cities(tables.read_gazetteer_documents(spark, path), 300).select("name", "population", "cityId")


def wkt_point(spark, sf):
    point = geo.wkt_point(F.col("longitude"), F.when(F.col("pos") % 5 != 0, F.col("latitude")))
    return inputs.gazetteer(spark, sf).select("pos", "name", point.alias("location"))


def wkt_points(spark, sf):
    """Points of two places per row, one of them without coordinates on every third row; none on every fourth."""
    place = F.struct("longitude", "latitude")
    absent = F.struct("longitude", F.when(F.col("pos") % 3 != 0, F.col("latitude")).alias("latitude"))
    listed = F.when(F.col("pos") % 4 != 0, F.array(place, absent)).otherwise(F.slice(F.array(place), 1, 0))
    points = F.transform(geo.wkt_points(listed), lambda p: F.coalesce(p, F.lit("-")))
    return inputs.gazetteer(spark, sf).select("pos", F.array_join(points, ";").alias("points"))


def match_cities(spark, sf):
    messages = table(spark, sf, "documents").select("doc_id", text.clean_text(F.col("text")).alias("content"))
    return enrich.match_cities(messages, inputs.gazetteer(spark, sf), "content", cleaned=True).select("doc_id", "city", "location")


def match_cities_large(spark, sf):
    """The same matches with the gazetteer in buckets of its names."""
    messages = table(spark, sf, "documents").select("doc_id", text.clean_text(F.col("text")).alias("content"))
    places = inputs.large(enrich.place_lookup(inputs.gazetteer(spark, sf)), "places")
    return enrich.match_cities(messages, places, "content", cleaned=True).select("doc_id", "city", "location")


def translation_decode(spark, sf):
    return decode_translation(inputs.linked_messages(spark, sf))


def analysis_unscored(spark, sf):
    return message_analysis(inputs.linked_messages(spark, sf), inputs.gazetteer(spark, sf))


def cited_places(spark, sf):
    return analytics.cited_places(message_analysis(inputs.document_messages(spark, sf), inputs.gazetteer(spark, sf)))


def top_cited_places(spark, sf):
    return analytics.top_cited_places(message_analysis(inputs.document_messages(spark, sf), inputs.gazetteer(spark, sf)))


def _event_messages(spark, sf):
    return table(spark, sf, "events").select(F.col("event_type").alias("channel"), F.col("ts").alias("data"))


def daily_volume(spark, sf):
    return analytics.daily_volume(_event_messages(spark, sf)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def daily_volume_difference(spark, sf):
    report = analytics.daily_volume_difference(_event_messages(spark, sf))
    # the first day has no difference; printed as text so that both sides show a missing value alike
    return report.select(
        "channel", F.date_format("day", "yyyy-MM-dd").alias("day"), "n", F.coalesce(F.col("difference").cast("string"), F.lit("none")).alias("difference")
    )


def non_null_counts(spark, sf):
    both = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return analytics.non_null_counts(both)


def export_citations(spark, sf):
    """Citations to JSON files and back."""
    path = work_path(spark, "citations-json")
    citations = match_cities(spark, sf)
    sinks.write_json(citations, path)
    return spark.read.schema(citations.schema).json(path)


QUERIES = {
    "gazetteer_normalise": gazetteer_normalise,
    "gazetteer_lookup": gazetteer_lookup,
    "gazetteer_first": gazetteer_first,
    "gazetteer_build": gazetteer_build,
    "gazetteer_documents_first": gazetteer_documents_first,
    "wkt_point": wkt_point,
    "wkt_points": wkt_points,
    "match_cities": match_cities,
    "match_cities_large": match_cities_large,
    "decode_translation": translation_decode,
    "message_analysis": analysis_unscored,
    "cited_places": cited_places,
    "top_cited_places": top_cited_places,
    "daily_volume": daily_volume,
    "daily_volume_difference": daily_volume_difference,
    "non_null_counts": non_null_counts,
    "export_citations": export_citations,
}

_GAZ = sql.gazetteer()
_FIRST = sql.first_places()
MATCHES_SQL = f"""
  SELECT doc_id, city, location
  FROM (SELECT doc_id, unnest({sql.place_words('content')}) AS city FROM (SELECT doc_id, {sql.clean('text')} AS content FROM documents))
  JOIN ({_FIRST}) USING (city)"""

CITED_SQL = f"""
  SELECT city, location, count(*) AS n
  FROM (SELECT unnest({sql.place_words('content')}) AS city FROM (SELECT {sql.clean('text')} AS content FROM documents))
  JOIN ({_FIRST}) USING (city) GROUP BY city, location"""

ANALYSIS_SQL = f"""
  SELECT id, channel, timestamp, traduction, city, location
  FROM (SELECT *, unnest({sql.place_words('traduction')}) AS city
        FROM (SELECT id, channel, ts AS timestamp, {sql.clean('translated')} AS traduction FROM ({inputs.LINKED_MESSAGES_SQL})))
  JOIN ({_FIRST}) USING (city)"""

_DAILY = "SELECT event_type AS channel, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2"

SQL = {
    "gazetteer_normalise": f"SELECT pos, name, CAST(population AS VARCHAR) AS population, latitude, longitude FROM ({_GAZ})",
    "gazetteer_lookup": f"""SELECT name, latitude, longitude
        FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY pos) AS r FROM ({_GAZ})) WHERE r = 1""",
    "gazetteer_first": f"""SELECT pos, upper(substr(name, 1, 1)) || substr(name, 2) AS name, population, pos AS "cityId"
        FROM ({_GAZ}) ORDER BY pos LIMIT 1512""",
    "gazetteer_documents_first": f"""SELECT upper(substr(name, 1, 1)) || substr(name, 2) AS name, population, pos AS "cityId"
        FROM ({_GAZ}) ORDER BY pos LIMIT 300""",
    "gazetteer_build": f"SELECT name, CAST(population AS VARCHAR) AS population, latitude, longitude FROM ({_GAZ})",
    "wkt_point": f"""SELECT pos, name, CASE WHEN pos % 5 <> 0 THEN 'POINT(' || longitude || ' ' || latitude || ')' END AS location FROM ({_GAZ})""",
    "wkt_points": f"""SELECT pos, CASE WHEN pos % 4 <> 0 THEN p || ';' || CASE WHEN pos % 3 <> 0 THEN p ELSE '-' END END AS points
        FROM (SELECT pos, 'POINT(' || longitude || ' ' || latitude || ')' AS p FROM ({_GAZ}))""",
    "match_cities": MATCHES_SQL,
    "match_cities_large": MATCHES_SQL,
    "decode_translation": f"SELECT id, channel, ts AS timestamp, 'deepl' AS service, translated AS text FROM ({inputs.LINKED_MESSAGES_SQL})",
    "message_analysis": ANALYSIS_SQL,
    "cited_places": CITED_SQL,
    "top_cited_places": f"SELECT * FROM ({CITED_SQL}) ORDER BY n DESC, city, location LIMIT 10",
    "daily_volume": f"SELECT channel, strftime(d, '%Y-%m-%d') AS day, n FROM ({_DAILY})",
    "daily_volume_difference": f"""SELECT channel, strftime(d, '%Y-%m-%d') AS day, n,
        coalesce(CAST(n - lag(n) OVER (PARTITION BY channel ORDER BY d) AS VARCHAR), 'none') AS difference FROM ({_DAILY})""",
    "non_null_counts": """SELECT count(d.doc_id) AS doc_id, count(text) AS text, count(lang) AS lang, count(source) AS source,
        count(n_chars) AS n_chars, count(quality) AS quality, count(toxic) AS toxic
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "export_citations": MATCHES_SQL,
}
