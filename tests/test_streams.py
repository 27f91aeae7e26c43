"""Streams: equal to the batch result, exactly once over restarts and replays, one checkpoint per query."""

import pytest
from pyspark.sql import functions as F

from msgflow import schemas
from msgflow.operators import enrich, state
from msgflow.plans.enrichment import link_intelligence, link_lookups, message_analysis
from msgflow.session import work_path
from msgflow.sources import messages as feeds
from msgflow.sources import sinks
from msgflow.streaming import jobs
from registered import inputs, training
from registered.inputs import table

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.select(*[f"`{c}`" for c in sorted(df.columns)]).collect()))


@pytest.mark.parametrize("small", [True, False])
def test_scored_streams_equal_the_batch(spark, monkeypatch, small):
    """Two runs over a growing feed, in small and in bucketed lookups, give the batch result of the whole feed."""
    if not small:
        monkeypatch.setattr(enrich, "is_small", lambda *_: False)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        model = training.fitted(spark, SF)
        messages = inputs.linked_messages(spark, SF)
        pages, registry, gazetteer = table(spark, SF, "pages"), inputs.registry(spark, SF), inputs.gazetteer(spark, SF)
        feed, out, checkpoints = (work_path(spark, n) for n in ("feed", "out", "checkpoints"))
        for part in range(2):
            feeds.encode_messages(messages.where(F.col("id").cast("bigint") % 2 == part)).write.mode("append").text(feed)
            stream = feeds.read_message_stream(spark, path=feed, per_trigger=3)
            jobs.wait_for(jobs.start_enrichment(stream, pages, registry, gazetteer, model, out, checkpoints, available_now=True))
        links = jobs.read_output(spark, f"{out}/links")
        cities = jobs.read_output(spark, f"{out}/citations")
        assert rows(links) == rows(link_intelligence(messages, link_lookups(pages, registry, model)))
        assert rows(cities) == rows(message_analysis(messages, gazetteer, model))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_output_survives_lookups_that_change_their_size(spark, monkeypatch):
    """Small, large, then small lookups on one checkpoint: every row is read once, through the folder and the declared table."""
    messages = inputs.linked_messages(spark, SF)
    pages, registry, gazetteer = table(spark, SF, "pages"), inputs.registry(spark, SF), inputs.gazetteer(spark, SF)
    feed, out, checkpoints = (work_path(spark, n) for n in ("feed", "out", "checkpoints"))
    measured = enrich.is_small
    for part in range(3):
        monkeypatch.setattr(enrich, "is_small", (lambda *_: False) if part == 1 else measured)
        feeds.encode_messages(messages.where(F.col("id").cast("bigint") % 3 == part)).write.mode("append").text(feed)
        stream = feeds.read_message_stream(spark, path=feed)
        jobs.wait_for(jobs.start_enrichment(stream, pages, registry, gazetteer, None, out, checkpoints, available_now=True))
    links = jobs.read_output(spark, f"{out}/links")
    assert rows(links) == rows(link_intelligence(messages, link_lookups(pages, registry)))
    jobs.output_tables(spark, out, f"t{out[-8:]}")
    declared = spark.table(f"t{out[-8:]}_links")
    assert "batch_id" not in declared.columns and declared.count() == links.count()


def test_restart_without_new_data_adds_nothing(spark):
    feed, out, checkpoint = (work_path(spark, n) for n in ("feed", "out", "checkpoint"))
    feeds.encode_messages(inputs.document_messages(spark, SF)).write.text(feed)
    counts = []
    for _ in range(2):
        decoded = feeds.decode_messages(feeds.read_message_stream(spark, path=feed))
        sinks.write_stream(decoded.select("id"), out, checkpoint, available_now=True).awaitTermination()
        counts.append(spark.read.parquet(out).count())
    assert counts[0] == counts[1] == table(spark, SF, "documents").count()


def test_replayed_batch_overwrites_itself(spark):
    out = work_path(spark, "fan-out")
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    written = [sinks.table_sink(f"{out}/table"), sinks.json_sink(f"{out}/json")]
    for _ in range(2):
        sinks.write_to_all(batch, 0, written)
    sinks.write_to_all(batch.limit(0), 1, written)
    assert jobs.read_output(spark, f"{out}/table").count() == spark.read.text(f"{out}/json").count() == 2


def test_malformed_and_missing_envelopes(spark):
    feed = spark.createDataFrame([('{"id":"1","text":["a"],"extra":1}',), ("not json",), ('{"translation":{"service":"x","text":["p","q"]}}',)], "value string")
    got = feeds.decode_messages(feed).collect()
    assert got[0]["id"] == "1" and got[0]["text"] == ["a"] and got[0]["views"] is None
    assert all(v is None for v in got[1])
    decoded = feeds.decode_translation(feeds.decode_messages(feed)).collect()
    assert decoded[2]["service"] == "x" and decoded[2]["text"] == '["p","q"]' and decoded[0]["text"] is None


def test_intake_time_is_added_only_where_missing(spark):
    feed = spark.createDataFrame([('[{"id":"1","@timestamp":"t"},{"id":"2"}]',)], "value string")
    got = {r["id"]: r for r in feeds.ingest_json_batches(feed).collect()}
    assert got["1"]["@timestamp"] == "t" and got["2"]["@timestamp"].endswith("Z") and got["2"]["type"] == "syslog"


def ingest_round(spark, arrivals, out, checkpoint, pages):
    pages.write.mode("append").parquet(arrivals)
    stream = spark.readStream.schema(schemas.CHANNEL_PAGE).parquet(arrivals)
    jobs.start_ingest(stream, out, checkpoint, available_now=True).awaitTermination()
    return jobs.read_output(spark, f"{out}/messages"), {r["channel"]: (r["last_id"], r["transaction_id"]) for r in jobs.current_state(spark, out).collect()}


def test_ingest_keeps_marks_over_rounds(spark):
    pages = inputs.channel_pages(spark, SF)
    arrivals, out, checkpoint = (work_path(spark, n) for n in ("pages", "ingest", "checkpoint"))
    first, marks = ingest_round(spark, arrivals, out, checkpoint, pages.where(F.col("url").endswith("page=0")))
    turns = table(spark, SF, "conversations")
    assert first.count() == turns.where("turn < 5").count()
    assert set(t for _, t in marks.values()) == {1}
    # the same pages again, with the later ones: only what is past the marks is new
    everything, later = ingest_round(spark, arrivals, out, checkpoint, pages)
    assert everything.count() == everything.select("channel", "id").distinct().count() == turns.count()
    for row in turns.groupBy("conv_id").agg((F.max("turn") + 1).alias("last")).collect():
        channel = f"ch{row['conv_id']}"
        assert later[channel] == (row["last"], 2 if row["last"] > 5 else 1)


def test_marks_never_move_back(spark):
    before = spark.createDataFrame([("a", 10, 9999), ("b", 3, None)], schemas.INGEST_STATE)
    messages = spark.createDataFrame([("a", "7"), ("b", "4"), ("c", "2"), ("c", "x"), ("c", "-5")], "channel string, id string")
    got = {r["channel"]: (r["last_id"], r["transaction_id"]) for r in state.advance_state(before, messages).collect()}
    assert got == {"a": (10, 0), "b": (4, 1), "c": (2, 1)}


def test_kafka_needs_servers_and_topic(spark):
    with pytest.raises(ValueError):
        feeds.read_message_stream(spark)
