"""A corpus from raw documents: toxicity, language, exact and near duplicates, packing.

Every stage works on all its predecessor kept. The first four return documents with their
columns; the last one returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.llm import exact_dedup, language, packing, queries, rows, simhash
from msgflow.llm.common import kept_rows, prepare
from msgflow.session import stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier calls toxic.

    Null and empty texts are scored like others; equal rows share their verdict; without labels nothing
    is known to be toxic; an empty table stays empty; further columns go through unchanged.
    """
    prepare(spark)
    model = spark.sparkContext.broadcast(queries.toxicity_model(docs, sf_dir))
    return kept_rows(docs, lambda texts: model.value.score(texts) < 0.5)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null and empty texts and those without a letter, or all when no label is known.

    Equal rows share their verdict; texts are read whole; an empty table stays empty; further columns go through unchanged.
    """
    prepare(spark)
    model = spark.sparkContext.broadcast(queries.language_model(docs))
    return kept_rows(docs, lambda texts: [found != language.UNDETERMINED for found in model.value.predict(texts.to_pylist())[0]])


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text: the one with the largest id, of equal ids one of them.

    A null text equals an empty one; null ids come last; an empty table stays empty; further
    columns, whatever their names, go through unchanged.
    """
    prepare(spark)
    numbered, number = rows.numbered(docs)
    judged = exact_dedup.exact_duplicates(numbered, uid_col=number)
    return rows.without(numbered, number, judged.where(~F.col("kept")).select("uid"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of fingerprints linked within two bits: the one with the smallest id.

    Texts without words (null and empty ones too) share a fingerprint, so one of them stays; a null id
    is kept only in a group without ids; an empty table stays empty; further columns go through unchanged.
    """
    prepare(spark)
    numbered, number = rows.numbered(docs)
    found = simhash.near_duplicates(numbered, uid_col=number)
    return rows.without(numbered, number, found.where(F.col("uid") != F.col("keep_uid")).select("uid"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences.

    A null or empty text is the end id alone; null, equal and repeated ids are packed like others; long texts
    are cut into several pieces; an empty table gives no pieces; further columns are ignored.
    """
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash", near_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # the classifiers and the packing have no SQL form; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
