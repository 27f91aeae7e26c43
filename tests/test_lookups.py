"""Registration, gazetteer, routing, options, reports and model cases by hand."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from msgflow import fixed_values as fv
from msgflow import schemas
from msgflow.functions import geo, records, whois
from msgflow.operators import analytics, enrich, routing, sentiment
from msgflow.session import work_path
from msgflow.sources import sinks, tables

TWO = [datetime(2020, 1, 2, 3, 4, 5), datetime(2021, 1, 1)]


def test_whois_json(spark):
    registry = spark.createDataFrame(
        [("a.com", ["A.COM", "a.com"], 'w"s', None, "Ünï", None, "S", "C", "IT", TWO[:1], TWO, None), ("b.com", [], *[None] * 10)],
        schemas.WHOIS_REGISTRY,
    )
    urls = spark.createDataFrame([(1, "https://x.a.com/p"), (2, "http://b.com:80"), (3, "https://c.com")], "n int, url string")
    got = {r["n"]: r["whois"] for r in enrich.enrich_whois(urls, registry).collect()}
    missing = {**dict.fromkeys(fv.WHOIS_FIELDS, "None"), **dict.fromkeys(fv.WHOIS_DATE_FIELDS, "0001-01-01 00:00:00")}
    found = {**missing, "domain_name": "a.com", "whois_server": 'w"s', "org": "Ünï", "state": "S", "city": "C", "country": "IT", "creation_date": "2020-01-02 03:04:05"}
    wanted = {1: found, 2: {**missing, "domain_name": "aa"}, 3: missing}
    assert got == {n: json.dumps(v, indent=4, ensure_ascii=False) for n, v in wanted.items()}


@pytest.mark.parametrize("url,domain", [
    ("https://it.wikipedia.org/wiki/X", "wikipedia.org"), ("https://www.kmu.gov.ua/en", "kmu.gov.ua"), ("http://a.b.co.uk:8080/x?y#z", "b.co.uk"),
    ("https://192.168.1.1/test.jpg", "192.168.1.1"), ("https://user@Host.Example.com", "example.com"), ("https://localhost", "localhost"), ("https://quora.com.", "quora.com"),
])
def test_registered_domain(spark, url, domain):
    assert spark.createDataFrame([(url,)], "u string").select(whois.registered_domain(F.col("u"))).first()[0] == domain


def test_page_lookup_and_fallback(spark):
    pages = spark.createDataFrame(
        [(2, "https://a.com/x?q=1", "<p>second</p>", 200), (1, "https://a.com/x/", "<p>first &amp; @me</p>", 200), (3, "https://b.com", "<p>gone</p>", 404), (4, "https://c.com", None, 200)],
        "page_id bigint, url string, html string, status int",
    )
    urls = spark.createDataFrame([(u,) for u in ("https://a.com/x", "https://b.com", "https://c.com", "https://d.com")], "url string")
    got = {r["url"]: r["content"] for r in enrich.enrich_pages(urls, pages).collect()}
    assert got == {"https://a.com/x": "first ", "https://b.com": "null", "https://c.com": "null", "https://d.com": "null"}


def test_cities_match_in_any_case_and_the_first_of_a_name_wins(spark):
    raw = spark.createDataFrame(
        [(5, "LIMA", 1, "9.5 8.5", 1), (2, "Lima", 10, "{'latitude': -12.040, 'longitude': -77}", 2), (3, "Rom", 1, "1 2", 3), (4, "Oslo", 5, "59.9 10.7", 4)],
        "pos bigint, name string, population bigint, location string, cityId bigint",
    )
    text = spark.createDataFrame([("lima Rom OSLO, Lima\tnothing",)], "t string")
    got = [(r["city"], r["location"]) for r in enrich.match_cities(text, tables.normalise_gazetteer(raw), "t").collect()]
    assert sorted(got) == [("lima", "POINT(-77.0 -12.04)")] * 2


@pytest.mark.parametrize("location,latitude,longitude", [
    ("{'__type': 'GeoPoint', 'latitude': -33.90, 'longitude': 151}", "-33.9", "151.0"), ("50.45, 30.523400", "50.45", "30.5234"), ("0.0 0", "0.0", "0.0"), ("none", None, None),
])
def test_coordinates(spark, location, latitude, longitude):
    frame = spark.createDataFrame([(location,)], "l string")
    assert frame.select(geo.coordinate(F.col("l"), 1), geo.coordinate(F.col("l"), 2)).first() == (latitude, longitude)


def test_daily_volume_with_unreadable_times(spark):
    frame = spark.createDataFrame([("a", "2022-03-01T23:30:00+00:00"), ("a", "2022-03-01T01:00:00+00:00"), ("a", "soon"), ("a", None)], "channel string, data string")
    got = {(str(r["day"]), r["n"]) for r in analytics.daily_volume(frame).collect()}
    assert got == {("2022-03-01", 2), ("None", 2)}


def test_wkt(spark):
    frame = spark.createDataFrame([("30.2", "50.1", [("1.0", "2.0"), ("3.0", None)]), (None, "1.0", [])], "lon string, lat string, p array<struct<longitude:string,latitude:string>>")
    got = frame.select(geo.wkt_point(F.col("lon"), F.col("lat")), geo.wkt_points(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("POINT(30.2 50.1)", ["POINT(1.0 2.0)", None]), (None, None)]


def test_gazetteer_files(spark):
    path = work_path(spark, "gazetteer")
    rows = spark.createDataFrame([(0, "kyiv", "5", "50.45", "30.52")], schemas.GAZETTEER)
    sinks.write_csv(rows, path)
    assert tables.read_gazetteer(spark, [path + "-absent", path]).collect() == rows.collect()
    assert tables.read_gazetteer(spark, [path + "-absent"]) is None


def routed(spark, keys, required=("en", "uk"), catalog=None):
    messages = spark.createDataFrame([(k, list(required)) for k in keys], "key bigint, required array<string>")
    catalog = tables.service_catalog(spark) if catalog is None else catalog
    return {r["key"]: r["service"] for r in routing.route_weighted(messages, catalog, "key").collect()}


def test_routing_ranges(spark):
    got = routed(spark, [0, 7, 8, 23, 39, 40])
    assert got == {0: "google", 7: "google", 8: "bing", 23: "deepl", 39: "itranslate", 40: "google"}


def test_routing_shares_equal_votes(spark):
    shares = {}
    for service in routed(spark, range(42), ("en", "ru")).values():
        shares[service] = shares.get(service, 0) + 1
    assert shares == {"google": 8, "bing": 8, "reverso": 7, "deepl": 9, "itranslate": 8, "argos": 2}


def test_routing_around_a_failed_service_and_without_any(spark):
    left = tables.service_catalog(spark).where("service != 'google'")
    assert routed(spark, [0], catalog=left) == {0: "bing"}
    assert routed(spark, [0], ("ch",)) == {0: None}
    assert routed(spark, [0], ("ch", "uk")) == {0: None}
    assert routed(spark, [0], ()) == {0: "google"}


def test_catalog_file(spark):
    path = work_path(spark, "catalog")
    spark.createDataFrame([(fv.SERVICE_CATALOG.rstrip("\n"),)], "v string").write.text(path)
    got = tables.read_catalog(spark, path).orderBy("pos")
    assert got.collect() == tables.service_catalog(spark).orderBy("pos").collect()
    assert got.first().asDict() == {"pos": 0, "service": "google", "vote": 8, "langs": ["en", "ru", "uk", "it", "de", "auto"]}


def test_emotion(spark):
    got = spark.createDataFrame([(1.0,), (0.0,), (None,)], "p double").select(records.emotion(F.col("p"))).collect()
    assert [r[0] for r in got] == ["positive", "negative", "negative"]


def test_checks(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "x int, y string")
    assert analytics.null_drop_counts(frame).first() == (3, 1)
    assert analytics.non_null_counts(frame).first() == (2, 1)
    assert analytics.accuracy(spark.createDataFrame([(1, 1.0), (0, 1.0)], "label int, prediction double")).first()[0] == 0.5


def test_model_learns_saves_loads_and_retrains(spark):
    good, bad = "happy sunny lovely bright day friends", "angry rainy awful dark night enemies"
    rows = [(i, (good if i % 2 else bad) + f" word{i % 3}", i % 2) for i in range(200)] + [(200, None, 1)]
    labelled = spark.createDataFrame(rows, "id bigint, content string, label int")
    path = work_path(spark, "model")
    done = sentiment.train_and_save(path, labelled, "id", weights=[0.7, 0.1, 0.2])
    assert done.accuracy == 1.0
    assert not sinks.save_model(done.model, path) and sinks.save_model(done.model, path, overwrite=True)
    loaded = sentiment.load_or_train(path, labelled, "id")
    texts = spark.createDataFrame([(good,), (bad,)], "content string")
    assert [r["emotion_detection"] for r in sentiment.score(texts, loaded).collect()] == ["positive", "negative"]
    fresh = sentiment.load_or_train(path + "-absent", labelled, "id")
    assert sentiment.score(texts, fresh).columns == ["content", "emotion_detection"]
    stages = loaded.stages
    assert (stages[0].getPattern(), stages[0].getMinTokenLength(), stages[2].getVectorSize(), stages[2].getWindowSize(), stages[2].getMinCount()) == (r"\W", 1, 100, 5, 5)
    assert (stages[3].getMaxIter(), stages[3].getTol(), stages[3].getThreshold(), stages[3].getRegParam()) == (100, 1e-6, 0.5, 0.0)
