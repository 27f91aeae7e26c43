"""Sentiment model: factory, training, storage and scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover, Word2Vec
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow import fixed_values as fv
from msgflow.functions.records import emotion
from msgflow.operators import word_vectors
from msgflow.operators.analytics import accuracy
from msgflow.operators.sampling import split_rows
from msgflow.session import spread
from msgflow.sources.sinks import save_model

_SCORE_COLUMNS = ["tokens", "filtered_words", "vector", "rawPrediction", "probability", "prediction"]


def tokeniser(input_col: str) -> RegexTokenizer:
    """Lower-case words between non-word characters, at least one character long."""
    return RegexTokenizer(inputCol=input_col, outputCol="tokens", pattern=r"\W", gaps=True, minTokenLength=1, toLowercase=True)


def stop_words() -> StopWordsRemover:
    return StopWordsRemover(inputCol="tokens", outputCol="filtered_words", caseSensitive=False)


MIN_COUNT = 5  # rarer words get no vector


def sentiment_stages(
    input_col: str = "input", label_col: str = "label", partitions: int = 1, seed: int = fv.SPLIT_SEED, min_count: int = MIN_COUNT
) -> Pipeline:
    """Unfitted model: words, stop words, mean word vectors, logistic regression.

    `partitions` is how many tasks learn word vectors; one task is exact sequential
    training, more let the training set grow with the cluster.
    """
    vectors = Word2Vec(
        inputCol="filtered_words", outputCol="vector", vectorSize=fv.VECTOR_SIZE, windowSize=5, minCount=min_count,
        maxIter=1, numPartitions=partitions, seed=seed,
    )
    regression = LogisticRegression(featuresCol="vector", labelCol=label_col, maxIter=100, tol=1e-6, threshold=0.5)
    return Pipeline(stages=[tokeniser(input_col), stop_words(), vectors, regression])


def least_count(words: DataFrame, column: str = "filtered_words", max_words: int | None = None) -> int:
    """The least count of a word, from `MIN_COUNT` on, such that at most `max_words` words reach it; `MIN_COUNT` when that is unset.

    Words are counted exactly, with map-side combine; the driver gets one row per count, of which there are
    fewer than the square root of twice the number of words in all texts.
    """
    if max_words is None:
        return MIN_COUNT
    counts = words.select(F.explode(column).alias("word")).groupBy("word").count()
    sizes = counts.where(F.col("count") >= MIN_COUNT).groupBy("count").agg(F.count("*").alias("words")).orderBy(F.desc("count")).collect()
    total, least = 0, None
    for row in sizes:
        total += row["words"]
        if total > max_words:
            break
        least = row["count"]
    return MIN_COUNT if total <= max_words else (sizes[0]["count"] + 1 if least is None else least)


LEARNERS = 4  # tasks that learn word vectors, at least
LEARNER_WORDS = 2_000_000  # words that one of them learns from


def learners(words: DataFrame, column: str = "filtered_words") -> int:
    """How many tasks learn word vectors: one for every `LEARNER_WORDS` words, `LEARNERS` at least.

    So a task ends in bounded time at any size, and the cluster decides how many run at once. The number
    follows the rows alone, so that it is the same on every cluster.
    """
    total = words.agg(F.sum(F.size(column))).first()[0] or 0
    return max(LEARNERS, -(-total // LEARNER_WORDS))


MERGED = 8  # partitions of words that one task of the regression takes, at most


def in_rounds(rows: DataFrame) -> DataFrame:
    """The same rows, spread evenly over as many partitions as there are cores, or more where a task would get more than `MERGED` of the old ones.

    The regression goes over its rows more than a hundred times, each time for a few milliseconds of a
    partition. What a round costs is the start of its tasks, and every task carries the plan behind its rows up to
    the last shuffle. Behind this one lie the vectors only, and not the plan that cleans the texts.
    """
    parts, cores = rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(min(parts, max(cores, -(-parts // MERGED))))


@dataclass
class Training:
    model: PipelineModel
    accuracy: float | None


def fit(rows: DataFrame, input_col: str, label_col: str, partitions: int | None = None, max_words: int | None = None) -> PipelineModel:
    """Fit the stages one after the other; the result is the model that fitting them as one would give.

    Words are computed once for both learners, and vectors once for the regression, which asks for its rows
    several times. `partitions` is the number of tasks of Spark ML
    that learn word vectors: one gives the exact sequential result; unset, tasks with memory of their own learn
    them (`word_vectors`), and their number follows the number of words (`learners`). All words that occur `MIN_COUNT` times get a vector, however many they are; only a
    caller that sets `max_words` gets the most frequent ones.
    """
    words_of, stops, vectors_of, regression = sentiment_stages(input_col, label_col).getStages()
    words = stops.transform(words_of.transform(spread(rows.select(input_col, label_col))))
    words = words.select("filtered_words", label_col).persist()
    try:
        vectors_of = vectors_of.setNumPartitions(partitions or learners(words)).setMinCount(least_count(words, max_words=max_words))
        vectors_of = vectors_of.fit(words) if partitions else word_vectors.fit(vectors_of, words)
        vectors = in_rounds(vectors_of.transform(words).select("vector", label_col)).persist()
        try:
            regression = regression.fit(vectors)
        finally:
            vectors.unpersist()
    finally:
        words.unpersist()
    return PipelineModel([words_of, stops, vectors_of, regression])


def train(
    labelled: DataFrame, key: str, input_col: str = "content", label_col: str = "label",
    weights: list[float] | None = None, partitions: int | None = None, max_words: int | None = None,
) -> Training:
    """Drop rows with nulls, split, fit on the first part, report accuracy on the third if it has weight."""
    weights = fv.SPLIT_WEIGHTS if weights is None else weights
    fit_part, _, test_part = split_rows(labelled.dropna(), key, weights)
    model = fit(fit_part, input_col, label_col, partitions, max_words)
    reached = None
    if weights[2] > 0:
        reached = accuracy(model.transform(test_part), label_col).first()["accuracy"]
    return Training(model, reached)


def load_or_train(path: str, labelled: DataFrame, key: str, redo: bool = False, **options) -> PipelineModel:
    """The saved model, or a newly trained one when there is none or `redo` is set."""
    if not redo:
        try:
            return PipelineModel.load(path)
        except Exception as error:  # noqa: BLE001 - any unreadable model means training
            print(f"no saved model at {path}: {type(error).__name__}")
    return train(labelled, key, **options).model


def train_and_save(path: str, labelled: DataFrame, key: str, overwrite: bool = False, **options) -> Training:
    done = train(labelled, key, **options)
    save_model(done.model, path, overwrite)
    return done


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add `emotion_detection`; works on batches and streams. The model reads its own input column."""
    return model.transform(df).withColumn("emotion_detection", emotion(F.col("prediction"))).drop(*_SCORE_COLUMNS)
