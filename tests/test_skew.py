"""Joins and reductions with a hot key give the plain result, also beyond broadcast size."""

import pytest
from pyspark.sql import functions as F

from msgflow.functions import text
from msgflow.operators import enrich, sampling, skew
from msgflow.operators.lookup import Lookup
from msgflow.plans import enrichment
from msgflow.session import is_small, work_path
from registered import inputs
from registered.inputs import table

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def facts(spark):
    """30,000 rows: a third on one key, a sixth without a key, the rest on 2,000 keys."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("hot")).when(n % 6 != 1, F.concat(F.lit("k"), (n % 2000).cast("string")))
    return spark.range(30_000).select("id", key.alias("key"))


@pytest.fixture
def dim(spark):
    known = spark.range(1_500).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("value"))
    return known.unionByName(spark.createDataFrame([("hot", -1)], "key string, value bigint"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_is_the_plain_join(spark, facts, dim, how):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows(skew.skew_join(facts, dim, "key", ["id"], how)) == rows(facts.join(dim, "key", how))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_few_and_split(facts):
    hot = skew.hot_keys(facts, "key").collect()
    assert [r["key"] for r in hot] == ["hot"] and hot[0]["_salts"] > 50


def test_hot_key_is_spread_over_tasks(spark, facts, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = skew.skew_join(facts, dim, "key", ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 2 * 30_000 / 8


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_bucketed_join_is_the_plain_join_and_leaves_the_lookup_in_place(spark, facts, dim, monkeypatch, how, few):
    if not few:
        monkeypatch.setattr(skew, "FEW_KEYS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lookup = Lookup(dim, "key", False).staged("dim")
        joined = lookup.join(facts, ["id"], how)
        plan = plan_of(joined)
        # Everything below the exchange is the facts' side; the lookup's scans stand below none.
        bucketed = [line for line in plan.splitlines() if "FileScan" in line and "Bucketed: true" in line]
        assert len(bucketed) >= 1 and plan.count("Exchange hashpartitioning") == 1
        assert rows(joined) == rows(facts.join(dim, "key", how))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * sum(sizes) / 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_bucketed_join_of_a_stretch_without_known_keys(spark, dim):
    lookup = Lookup(dim, "key", False).staged("dim")
    facts = spark.createDataFrame([(1, None), (2, "absent")], "id bigint, key string")
    assert rows(lookup.join(facts, ["id"])) == rows(facts.join(dim, "key", "left"))
    assert lookup.join(facts.where("false"), ["id"]).count() == 0


def test_texts_do_not_travel_with_their_tokens(spark, monkeypatch):
    words = [f"word{chr(97 + i)}" for i in range(20)]
    rows_ = [(i, " ".join(words[(i + j) % 20] for j in range(60)), "x") for i in range(300)]
    messages = spark.createDataFrame(rows_, "n bigint, content string, city_code string")
    gazetteer = spark.createDataFrame([(i, w, "1.0", "2.0") for i, w in enumerate(words[::3])], "pos bigint, name string, latitude string, longitude string")
    places = enrich.place_lookup(gazetteer)
    seen = []

    def join(self, facts, *rest, plain=Lookup.join, **named):
        seen.append(facts.columns)
        return plain(self, facts, *rest, **named)

    monkeypatch.setattr(Lookup, "join", join)
    large = enrich.match_cities(messages, Lookup(places.rows, "city", False).staged("places"), "content", cleaned=True)
    assert seen == [["_message", "city"]]
    assert rows(large) == rows(enrich.match_cities(messages, gazetteer, "content", cleaned=True))


def test_first_per_key_and_without_copies(spark, facts, monkeypatch):
    wanted = rows(facts.where("key is not null").groupBy("key").agg(F.min("id").alias("id")))
    assert rows(skew.first_per_key(facts, "key", "id")) == wanted
    assert rows(skew.without_copies(facts, "key", "id")) == wanted
    monkeypatch.setattr(skew, "is_small", lambda *_: False)
    assert rows(skew.without_copies(facts, "key", "id")) == wanted


def test_running_total(spark):
    numbers = spark.range(1_000).select("id", (F.col("id") % 7).alias("v"))
    got = {r["id"]: r["total"] for r in skew.running_total(numbers, "id", "v", "total", block=64).collect()}
    total = 0
    for i in range(1_000):
        total += i % 7
        assert got[i] == total


def test_link_intelligence_beyond_broadcast_size(spark, monkeypatch):
    """The path for large lookup tables gives the result of the path for small ones."""

    def run():
        lookups = enrichment.link_lookups(table(spark, SF, "pages"), inputs.registry(spark, SF))
        return enrichment.link_intelligence(inputs.linked_messages(spark, SF), lookups, work_path(spark, "urls"))

    small = rows(run())
    monkeypatch.setattr(enrich, "is_small", lambda *_: False)
    monkeypatch.setattr(skew, "is_small", lambda *_: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows(run()) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_match_cities_beyond_broadcast_size(spark, monkeypatch):
    messages = table(spark, SF, "documents").select("doc_id", F.lower("text").alias("content"))
    small = rows(enrich.match_cities(messages, inputs.gazetteer(spark, SF), "content").drop("content"))
    monkeypatch.setattr(enrich, "is_small", lambda *_: False)
    assert rows(enrich.match_cities(messages, inputs.gazetteer(spark, SF), "content").drop("content")) == small


def test_cleaned_text_matches_alike(spark):
    messages = table(spark, SF, "documents").select("doc_id", text.clean_text(F.col("text")).alias("content"))
    gazetteer = inputs.gazetteer(spark, SF)
    general, cleaned = (enrich.match_cities(messages, gazetteer, "content", c).drop("content") for c in (False, True))
    assert rows(general) == rows(cleaned)


def test_split_is_whole_disjoint_and_weighted(spark):
    df = spark.range(10_000)
    parts = sampling.split_rows(df, "id", [0.7, 0.2, 0.1])
    ids = [{r["id"] for r in p.collect()} for p in parts]
    assert sum(map(len, ids)) == 10_000 and len(set().union(*ids)) == 10_000
    assert [abs(len(i) / 10_000 - w) < 0.03 for i, w in zip(ids, [0.7, 0.2, 0.1])] == [True] * 3
    again = sampling.split_rows(df.repartition(13), "id", [0.7, 0.2, 0.1])
    assert {r["id"] for r in again[2].collect()} == ids[2]
    whole, *empty = sampling.split_rows(df, "id")
    assert whole.count() == 10_000 and all(e.count() == 0 for e in empty)


@pytest.mark.parametrize("fraction,rows_wanted", [(0.0, 0), (0.05, 50), (0.333, 333), (1.0, 999)])
def test_sample_has_the_exact_size(spark, fraction, rows_wanted):
    sample = sampling.sample_exact(spark.range(999), "id", fraction)
    assert sample.count() == rows_wanted == sample.distinct().count()


def test_size_check(spark):
    wide = spark.range(50).select(F.repeat(F.lit("x"), 1_000).alias("v"))
    assert is_small(wide) and is_small(wide, max_rows=50, max_bytes=50_000) and is_small(wide.limit(0))
    assert not is_small(wide, max_rows=49) and not is_small(wide, max_bytes=49_999)
    many = spark.range(5_000)
    assert is_small(many, max_rows=5_000) and not is_small(many, max_rows=4_999)
