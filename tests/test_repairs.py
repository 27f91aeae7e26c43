"""Cases in which rows or values were wrong before."""

import inspect
import json
import os

import pytest
from pyspark.sql import functions as F

from msgflow import schemas, session
from msgflow.operators import analytics, domains, enrich, sampling, sentiment, skew
from msgflow.sources import tables
from registered import scored, training


@pytest.mark.parametrize("small", [True, False])
def test_one_row_per_key_on_ties(spark, monkeypatch, small):
    monkeypatch.setattr(skew, "is_small", lambda *_: small)
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", None, "n"), ("c", None, "p"), ("c", None, "o"), ("d", 4, "w"), (None, 1, "q")]
    found = skew.without_copies(spark.createDataFrame(rows, "key string, id int, text string"), "key", "id").collect()
    assert sorted(tuple(r) for r in found) == [("a", 1, "x"), ("b", None, "n"), ("c", None, "o"), ("d", 4, "w")]


def test_unreadable_days_are_no_day_before(spark):
    rows = [("c", "nonsense")] * 3 + [("c", "2024-01-01T00:00:00")] + [("c", "2024-01-03T00:00:00")] * 2
    found = analytics.daily_volume_difference(spark.createDataFrame(rows, "channel string, data string")).select(F.col("day").cast("string"), "n", "difference")
    assert {r["day"]: (r["n"], r["difference"]) for r in found.collect()} == {None: (3, None), "2024-01-01": (1, None), "2024-01-03": (2, 1)}


def test_first_in_source_over_several_documents(spark, tmp_path):
    """Files in order of their names, documents in order of their lines, cities in order of their lists."""
    def line(*cities):
        return json.dumps({"results": [{"name": n, "population": 1, "location": f"{{'latitude': {v}, 'longitude': 30.0}}", "cityId": 1} for n, v in cities]}) + "\n"

    (tmp_path / "a.json").write_text(line(("Kyiv", 50.9), ("Lviv", 1.5)) + line(("Kyiv", 10.1), ("Odesa", 2.5)) + line())
    (tmp_path / "b.json").write_text(line(("Lviv", 3.5), ("Dnipro", 4.5)) + line(("Dnipro", 5.5)))
    cities = tables.read_gazetteer_documents(spark, str(tmp_path))
    assert [r["name"] for r in tables.first_cities(cities, 4).collect()] == ["Kyiv", "Lviv", "Kyiv", "Odesa"]
    found = {r["name"]: r["latitude"] for r in tables.gazetteer_lookup(tables.normalise_gazetteer(cities)).collect()}
    assert found == {"kyiv": "50.9", "lviv": "1.5", "odesa": "2.5", "dnipro": "4.5"}


RULES = ["// rules", "com", "mx", "com.mx  // with a comment", "*.ck", "!www.ck", "uk", "co.uk", "a.b.co.uk", "", "COM.AU", "*.kawasaki.jp", "!city.kawasaki.jp", "jp"]
DOMAINS = {
    "https://x.com.mx/p": "x.com.mx", "http://y.com.mx": "y.com.mx", "https://a.x.com.mx": "x.com.mx", "https://x.mx": "x.mx", "https://com.mx": "com.mx",
    "https://a.b.c.ck": "b.c.ck", "https://c.ck": "c.ck", "https://d.www.ck": "www.ck", "https://www.ck": "www.ck", "https://z.a.b.co.uk": "z.a.b.co.uk", "https://b.co.uk": "b.co.uk",
    "https://N.Com.Au": "n.com.au", "https://p.q.city.kawasaki.jp": "city.kawasaki.jp", "https://p.q.r.kawasaki.jp": "q.r.kawasaki.jp", "https://u.v.unknown": "v.unknown",
    "https://10.20.30.40:8/x": "10.20.30.40", "https://localhost": "localhost", "https://user@s.t.com.": "t.com", "": None,
}


@pytest.mark.parametrize("small", [True, False])
def test_domains_by_suffix_rules(spark, monkeypatch, small):
    monkeypatch.setattr(domains, "is_small", lambda *_: small)
    rules = domains.suffix_rules(spark.createDataFrame([(r,) for r in RULES], "value string"))
    urls = spark.createDataFrame([(u,) for u in [*DOMAINS, None]], "url string")
    assert {r["url"]: r["domain"] for r in domains.with_domain(urls, rules).collect()} == {**DOMAINS, None: None}
    assert domains.with_domain(urls, rules.where("false")).where("url = 'https://x.com.mx/p'").first()["domain"] == "com.mx"


def test_registrations_by_suffix_rules(spark):
    registry = spark.createDataFrame([(d, [d], *[None] * 10) for d in ("x.com.mx", "com.mx")], schemas.WHOIS_REGISTRY)
    urls = spark.createDataFrame([("https://w.x.com.mx/1",), ("https://y.com.mx",)], "url string")
    rules = domains.suffix_rules(spark.createDataFrame([("com.mx",), ("mx",)], "value string"))
    found = {r["url"]: r["whois_domain_name"] for r in enrich.enrich_whois(urls, registry, as_json=False, suffixes=rules).collect()}
    assert found == {"https://w.x.com.mx/1": "x.com.mx", "https://y.com.mx": "None"}


def test_exact_sample_reads_its_input_twice(spark, tmp_path):
    spark.range(5_000).withColumnRenamed("id", "n").write.parquet(f"{tmp_path}/t")
    sample = sampling.sample_exact(spark.read.parquet(f"{tmp_path}/t"), "n", 0.13)
    assert sample._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    assert sample.count() == sample.distinct().count() == 650


@pytest.mark.parametrize("max_words, expected", [(10, 5), (3, 5), (2, 7), (1, 9), (0, 10)])
def test_vocabulary_has_a_ceiling(spark, max_words, expected):
    words = ["a"] * 9 + ["b"] * 7 + ["c"] * 5 + ["d"] * 4
    frame = spark.createDataFrame([(words[i::5],) for i in range(5)], "filtered_words array<string>")
    assert sentiment.least_count(frame, max_words=max_words) == expected


def test_vocabulary_is_whole_unless_a_ceiling_is_given(spark):
    words = F.sequence(F.col("id") * 3000, F.col("id") * 3000 + 2999)  # 501,000 words, each five times
    frame = spark.range(167).select(F.explode(F.array_repeat(F.transform(words, lambda n: n.cast("string")), 5)).alias("filtered_words"))
    assert sentiment.least_count(frame) == sentiment.MIN_COUNT
    assert {inspect.signature(f).parameters["max_words"].default for f in (sentiment.fit, sentiment.train)} == {None}


def test_training_with_a_small_vocabulary(spark):
    good, bad = "happy sunny lovely bright day friends", "angry rainy awful dark night enemies"
    labelled = spark.createDataFrame([(i, (good if i % 2 else bad) + " shared", i % 2) for i in range(60)], "id bigint, content string, label int")
    done = sentiment.train(labelled, "id", max_words=5)
    assert done.model.stages[2].getVectors().count() == 1  # thirteen words, of which twelve tie below the first


def test_work_tables_have_an_end(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    staged = session.stage(spark.range(3), "kept")
    keyed = session.stage_by_key(spark.range(3), "keyed", "id")
    assert staged.count() == keyed.count() == 3 and len(session._made) == 2
    path, (_, name) = session._made[0][0], session._made[1]
    assert spark.catalog.tableExists(name) and os.path.isdir(path)
    assert session.clear_work(spark) == 2 and session.clear_work(spark) == 0
    assert not spark.catalog.tableExists(name) and not os.path.exists(path)


@pytest.mark.parametrize("texts, expected", [(0, 4), (3, 4), (9, 9), (10, 10)])
def test_learners_follow_the_words(spark, monkeypatch, texts, expected):
    monkeypatch.setattr(sentiment, "LEARNER_WORDS", 6)
    frame = spark.createDataFrame([(["w"] * 6,)] * texts, "filtered_words array<string>")
    assert sentiment.learners(frame) == expected


def test_word_vectors_are_learned_by_as_many_tasks_as_the_words_need(spark, monkeypatch):
    monkeypatch.setattr(sentiment, "LEARNER_WORDS", 42)
    good, bad = "happy sunny lovely bright day friends", "angry rainy awful dark night enemies"
    labelled = spark.createDataFrame([(i, (good if i % 2 else bad) + " shared", i % 2) for i in range(60)], "id bigint, content string, label int")
    assert sentiment.train(labelled, "id").model.stages[2].getNumPartitions() == 10
    assert sentiment.train(labelled, "id", partitions=1).model.stages[2].getNumPartitions() == 1


def test_feed_with_an_empty_batch_is_written_by_many_tasks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scored, "work_path", lambda _, label: f"{tmp_path}/{label}")
    spark.range(400).selectExpr("id AS doc_id", "'a\nb' AS text", "'s' AS source").write.parquet(f"{tmp_path}/documents.parquet")
    found = scored.stream_empty_batches(spark, str(tmp_path)).collect()
    assert sorted(int(r["id"]) for r in found) == list(range(400)) and {r["folders"] for r in found} == {2}
    lines = [len((tmp_path / "feed" / name).read_text().splitlines()) for name in os.listdir(tmp_path / "feed") if name.startswith("part-")]
    assert sum(lines) == 400 and max(lines) < 100


def test_mean_vectors_shuffle_no_words(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "happy day happy"), (2, "dark night"), (3, "unheard"), (4, "")], "doc_id bigint, content string").withColumn("label", F.col("doc_id") % 2)
    model = sentiment.fit(rows.where("doc_id < 3").union(rows.where("doc_id < 3")).crossJoin(spark.range(5)).drop("id"), "content", "label")
    monkeypatch.setattr(training, "fitted", lambda *_: model)
    monkeypatch.setattr(scored.inputs, "labelled", lambda *_: rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # vectors beyond the size that Spark broadcasts by itself
    try:
        found = scored.mean_vectors(spark, "")
        assert "Exchange hashpartitioning(word" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in found.collect()) == [(1, 3, True), (2, 2, True), (3, 0, True), (4, 0, True)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_regression_runs_in_as_many_tasks_as_cores(spark, monkeypatch):
    seen, learn = [], sentiment.LogisticRegression.fit
    monkeypatch.setattr(sentiment.LogisticRegression, "fit", lambda self, rows: seen.append(rows) or learn(self, rows))
    good, bad = "happy sunny lovely bright day friends", "angry rainy awful dark night enemies"
    cores = spark.sparkContext.defaultParallelism
    for parts, expected in ((4 * cores, cores), (10 * cores, -(-10 * cores // sentiment.MERGED)), (1, 1)):
        rows = spark.createDataFrame([(good if i % 2 else bad, i % 2) for i in range(60)], "content string, label int").repartition(parts)
        model = sentiment.fit(rows, "content", "label")
        assert seen[-1].rdd.getNumPartitions() == expected
        assert seen[-1].count() == 60 and model.transform(rows).where("prediction = label").count() == 60


def test_regression_takes_vectors_spread_evenly_and_computed_once(spark, monkeypatch):
    seen, learn = [], sentiment.LogisticRegression.fit

    def fit(self, rows):
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        seen.append((rows.is_cached or rows.storageLevel.useMemory, sorted(sizes)))
        return learn(self, rows)

    monkeypatch.setattr(sentiment.LogisticRegression, "fit", fit)
    good, bad = "happy sunny lovely bright day friends", "angry rainy awful dark night enemies"
    cores = spark.sparkContext.defaultParallelism
    rows = spark.createDataFrame([(good if i % 2 else bad, i % 2) for i in range(10 * cores)], "content string, label int")
    model = sentiment.fit(rows.repartition(4 * cores, F.lit(0)), "content", "label")  # all of them in one partition of many
    assert seen == [(True, [10] * cores)]
    assert model.transform(rows).where("prediction = label").count() == 10 * cores
