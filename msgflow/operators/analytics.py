"""Reports over the enriched tables, and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def cited_places(citations: DataFrame) -> DataFrame:
    """Number of citations per place."""
    return citations.groupBy("city", "location").agg(F.count("*").alias("n"))


def top_cited_places(citations: DataFrame, k: int = 10) -> DataFrame:
    """The k most cited places, ties by name."""
    return cited_places(citations).orderBy(F.desc("n"), "city", "location").limit(k)


def daily_volume(messages: DataFrame) -> DataFrame:
    """Messages per channel and day. `data` is the post time; messages without a readable one count under a null day."""
    day = F.to_date(F.col("data").try_cast("timestamp")).alias("day")
    return messages.groupBy("channel", day).agg(F.count("*").alias("n"))


def daily_volume_difference(messages: DataFrame) -> DataFrame:
    """Change of the daily volume against the channel's previous day with messages; days without messages are passed over.

    The null day is no day before another: it has no difference, and the first real day has none either.
    The window runs over one row per day, after the counts.
    """
    by_day = Window.partitionBy("channel", F.col("day").isNull()).orderBy("day")
    return daily_volume(messages).withColumn("difference", F.col("n") - F.lag("n").over(by_day))


def non_null_counts(df: DataFrame) -> DataFrame:
    """Non-null values per column, in one pass."""
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])


def null_drop_counts(df: DataFrame) -> DataFrame:
    """Rows before and after dropping those with a null, in one pass."""
    complete = F.lit(True)
    for name in df.columns:
        complete = complete & F.col(f"`{name}`").isNotNull()
    return df.agg(F.count("*").alias("before_na"), F.count(F.when(complete, 1)).alias("after_na"))


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label."""
    correct = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return predictions.agg(F.avg(correct).alias("accuracy"))
