"""Registered queries over training data and the sentiment model."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgflow import fixed_values as fv
from msgflow.functions import records
from msgflow.operators import analytics, sampling, sentiment
from msgflow.plans.enrichment import link_intelligence, link_lookups, message_analysis
from msgflow.plans.preparation import clean_labelled, prepare_training
from msgflow.session import work_path
from msgflow.sources import sinks, tables
from registered import inputs, sql
from registered.inputs import table

_models: dict[tuple, object] = {}


def fitted(spark, sf):
    """The sentiment model of the labelled documents, trained once per session and saved to the shared folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _models:
        path = work_path(spark, "sentiment-model")
        sentiment.train_and_save(path, inputs.labelled(spark, sf), "doc_id")
        _models[key] = sentiment.load_or_train(path, inputs.labelled(spark, sf), "doc_id")
    return _models[key]


def _raw_tweets(spark, sf):
    """Labelled documents as one-line raw tweets."""
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return labelled.select(
        (F.col("quality") * 4).alias("sentiment"),
        F.col("doc_id").cast("string").alias("id"),
        F.lit("Mon Jan 01 00:00:00 UTC 2024").alias("date"),
        F.lit("NO_QUERY").alias("query_string"),
        F.col("source").alias("user"),
        F.regexp_replace("text", r"[\r\n]+", " ").alias("content"),
    )


def raw_tweets(spark, sf):
    """Headerless CSV written, read with given names, unused columns dropped, cleaned and labelled."""
    path = work_path(spark, "raw-tweets")
    sinks.write_csv(_raw_tweets(spark, sf), path, header=False)
    return clean_labelled(tables.read_raw_tweets(spark, path))


def prepared_sample(spark, sf):
    cleaned, sample = work_path(spark, "cleaned-tweets"), work_path(spark, "cleaned-tweets-sample")
    prepare_training(_raw_tweets(spark, sf).select("id", "sentiment", "content"), "id", cleaned, sample, 0.25)
    return tables.read_labelled(spark, sample)


def labelled_inferred(spark, sf):
    path = work_path(spark, "labelled")
    sinks.write_csv(inputs.labelled(spark, sf).select("content", "label"), path)
    return tables.read_labelled(spark, path, infer=True)


def labelled_italian(spark, sf):
    quality, toxic = F.col("quality"), F.col("toxic")
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias("id"), F.lit(1).alias("subjective"), quality.alias("positive"), toxic.alias("negative"),
        F.lit(0).alias("ironic"), quality.alias("lpositive"), toxic.alias("lnegative"), F.lit(0).alias("top"),
        F.regexp_replace("text", r"[\r\n]+", " ").alias("page_text"),
    )
    path = work_path(spark, "labelled-italian")
    sinks.write_csv(rows, path)
    return tables.read_labelled_italian(spark, path)


def null_drop_counts(spark, sf):
    return analytics.null_drop_counts(table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left"))


def drop_nulls(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").dropna().select("doc_id", "quality")


def binary_label(spark, sf):
    return table(spark, sf, "labels").select("doc_id", records.binary_label(F.col("quality") * 4).alias("label"))


def emotion_label(spark, sf):
    prediction = F.when(F.col("toxic") == 0, F.col("quality").cast("double"))
    return table(spark, sf, "labels").select("doc_id", records.emotion(prediction).alias("emotion"))


_WEIGHTS = [0.7, 0.2, 0.1]


def split_rows(spark, sf):
    parts = sampling.split_rows(table(spark, sf, "documents").select("doc_id"), "doc_id", _WEIGHTS)
    named = [part.withColumn("part", F.lit(name)) for part, name in zip(parts, ("train", "validation", "test"))]
    return named[0].unionByName(named[1]).unionByName(named[2])


def sample_exact(spark, sf):
    return sampling.sample_exact(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")


def accuracy(spark, sf):
    predictions = table(spark, sf, "labels").select(F.col("quality").alias("label"), (1 - F.col("toxic")).cast("double").alias("prediction"))
    return analytics.accuracy(predictions).select(F.round("accuracy", 9).alias("accuracy"))


def model_tokens(spark, sf):
    words = sentiment.tokeniser("content").transform(inputs.labelled(spark, sf))
    kept = sentiment.stop_words().transform(words)
    return kept.select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("filtered_words", " ").alias("filtered_words")
    )


def sentiment_score(spark, sf):
    labelled = inputs.labelled(spark, sf)
    return sentiment.score(labelled, fitted(spark, sf)).select("doc_id", "label", "emotion_detection")


def sentiment_accuracy(spark, sf):
    done = sentiment.train(inputs.labelled(spark, sf), "doc_id", weights=[0.8, 0.0, 0.2])
    return spark.createDataFrame([(done.accuracy,)], "accuracy double")


def sentiment_other_columns(spark, sf):
    """The second trained variant: input `text`, label `positive`."""
    rows = inputs.labelled(spark, sf).select("doc_id", F.col("content").alias("text"), F.col("label").alias("positive"))
    done = sentiment.train(rows, "doc_id", "text", "positive")
    return sentiment.score(rows, done.model).select("doc_id", "emotion_detection")


def links_scored(spark, sf):
    lookups = link_lookups(table(spark, sf, "pages"), inputs.registry(spark, sf), fitted(spark, sf))
    return link_intelligence(inputs.linked_messages(spark, sf), lookups)


def analysis_scored(spark, sf):
    return message_analysis(inputs.linked_messages(spark, sf), inputs.gazetteer(spark, sf), fitted(spark, sf))


QUERIES = {
    "raw_tweets": raw_tweets,
    "prepared_sample": prepared_sample,
    "labelled_inferred": labelled_inferred,
    "labelled_italian": labelled_italian,
    "null_drop_counts": null_drop_counts,
    "drop_nulls": drop_nulls,
    "binary_label": binary_label,
    "emotion_label": emotion_label,
    "split_rows": split_rows,
    "sample_exact": sample_exact,
    "accuracy": accuracy,
    "model_tokens": model_tokens,
    "sentiment_score": sentiment_score,
    "sentiment_accuracy": sentiment_accuracy,
    "sentiment_other_columns": sentiment_other_columns,
    "link_intelligence_scored": links_scored,
    "message_analysis_scored": analysis_scored,
}

# The English stop words of the model's word filter (single words; the
# contractions in the full list hold an apostrophe and never come out of the tokeniser).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its
itself they them their theirs themselves what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while of at by for with about against between
into through during before after above below to from up down in out on off over under again further then once here there
when where why how all any both each few more most other some such no nor not only own same so than too very s t can will
just don should now cannot could ought would
""".split()

_LABELLED = "SELECT d.doc_id, d.text, d.source, l.quality, l.toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id"
_ONE_LINE = "regexp_replace(text, '[\\r\\n]+', ' ', 'g')"
_RANKED = "row_number() OVER (ORDER BY {hash}, {key})"


def _sample_sql(rows: str, key: str, fraction: float, columns: str) -> str:
    rank = _RANKED.format(hash=sql.md5_number(key, fv.SPLIT_SEED), key=key)
    return f"""SELECT {columns} FROM (SELECT *, {rank} AS r FROM ({rows}))
        WHERE r <= (SELECT CAST(round_even(count(*) * CAST({fraction} AS DOUBLE), 0) AS BIGINT) FROM ({rows}))"""


_SPOT = f"({sql.md5_number('doc_id', fv.SPLIT_SEED)} / 4294967296.0)"

SQL = {
    "raw_tweets": f"SELECT {sql.clean(_ONE_LINE)} AS content, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label FROM ({_LABELLED})",
    "prepared_sample": _sample_sql(
        f"SELECT CAST(doc_id AS VARCHAR) AS id, {sql.clean(_ONE_LINE)} AS content, quality AS label FROM ({_LABELLED})", "id", 0.25, "content, label"
    ),
    "labelled_inferred": f"SELECT {sql.clean('text')} AS content, quality AS label FROM ({_LABELLED})",
    "labelled_italian": f"""SELECT CAST(doc_id AS VARCHAR) AS id, 1 AS subjective, quality AS positive, toxic AS negative, 0 AS ironic,
        quality AS lpositive, toxic AS lnegative, 0 AS top, {_ONE_LINE} AS page_text FROM ({_LABELLED})""",
    "null_drop_counts": """SELECT count(*) AS before_na, count(CASE WHEN d.text IS NOT NULL AND quality IS NOT NULL THEN 1 END) AS after_na
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "drop_nulls": f"SELECT doc_id, quality FROM ({_LABELLED})",
    "binary_label": "SELECT doc_id, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label FROM labels",
    "emotion_label": "SELECT doc_id, CASE WHEN toxic = 0 AND quality = 1 THEN 'positive' ELSE 'negative' END AS emotion FROM labels",
    "split_rows": f"""SELECT doc_id, CASE WHEN {_SPOT} < 0.7 THEN 'train' WHEN {_SPOT} < 0.9 THEN 'validation' ELSE 'test' END AS part FROM documents""",
    "sample_exact": _sample_sql("SELECT doc_id, source FROM documents", "doc_id", fv.SAMPLE_FRACTION, "doc_id, source"),
    "accuracy": "SELECT round(avg(CASE WHEN quality = 1 - toxic THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM labels",
    "model_tokens": f"""SELECT doc_id, len(t) AS n_tokens,
        array_to_string(list_filter(t, lambda w: NOT list_contains({STOP_WORDS}, w)), ' ') AS filtered_words
        FROM (SELECT doc_id, list_filter(string_split_regex({sql.clean('text')}, '[^A-Za-z0-9_]'), lambda w: w <> '') AS t FROM ({_LABELLED}))""",
}
