"""Registered queries of the operators, over whole tables, and SQL where it can express them."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.llm import chat_format, exact_dedup, katz, language, packing, periodic_runs, pieces, prefix_trie, simhash, token_files, toxicity, url_filter, vector_dedup
from msgflow.llm.common import remainder, table
from msgflow.session import work_path


def toxicity_model(docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    labels = table(docs.sparkSession, sf_dir, "labels")
    return toxicity.train_model(*toxicity.training_texts(docs, labels, remainder(F.col("doc_id"), 5) != 0))


def language_model(docs: DataFrame) -> language.LanguageModel:
    return language.train_model(language.training_samples(docs, remainder(F.col("doc_id"), 4) != 2))


def held_out(modulus: int, value: int) -> Column:
    """A document without an id is in no fold."""
    return F.coalesce(remainder(F.col("doc_id"), modulus) == value, F.lit(False)).alias("held_out")


RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs are labelled by the documents of the same id: blocked when of low quality or toxic."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("blocked")
    )
    model = url_filter.train_model(pages.select("page_id", "url").join(labels, "page_id"))
    return url_filter.judge_urls(pages, RULES, model)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxicity_model(docs, sf_dir))
    return scored.select("doc_id", held_out(5, 0), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language_model(docs)).select("doc_id", held_out(4, 2), "lang_pred", "score")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per chunk of every text: the number of ids, their checksum and that of the bytes they decode to, and the score."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digest_pieces(pieces.encode_pieces(table(spark, sf_dir, "documents"), path), path)


def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.score_texts(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) != 2)
    return scored.select("doc_id", held_out(7, 2), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = work_path(spark, "token-ids")
    token_files.write_token_files(docs, folder, lambda: public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_token_files(spark, folder)


def repeated_words(doc_id: int | None, n: int) -> np.ndarray | None:
    """For a tenth of the documents, by their id: from some word on, the words repeat with a period."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or n == 0:
        return None
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    words = np.arange(n)
    return np.where(words < first, words, first + (words - first) % period)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest_runs(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), order_of=repeated_words))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations are rebuilt: up to three turns of the conversation whose id is the next lower multiple of twenty come first."""
    turns, stretches = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    base, head = F.col("conv") - F.col("conv") % 20, F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return prefix_trie.prefix_trie(prefix_trie.prefixes(turns, stretches, base, head, longest_head=3))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_packing": op2_packing,
    "op3_pieces": op3_pieces,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_language": op7_language,
    "op8_katz": op8_katz,
    "op9_vector_dedup": op9_vector_dedup,
    "op10_chat_format": op10_chat_format,
    "op11_token_files": op11_token_files,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_prefix_trie": op13_prefix_trie,
}

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op4_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256({_FOLD}) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY {_FOLD})""",
    "op10_chat_format": """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
logs AS (
  SELECT conv_id, list({'t': turn, 'r': role, 'x': text} ORDER BY turn, role, text) AS steps FROM
    (SELECT conv_id, turn - min(turn) OVER (PARTITION BY conv_id) AS turn, role, text FROM rows) GROUP BY conv_id),
kept AS (
  SELECT a.conv_id FROM logs a WHERE NOT EXISTS (
    SELECT 1 FROM logs b WHERE b.steps[1] = a.steps[1] AND b.conv_id <> a.conv_id AND b.steps[1:len(a.steps)] = a.steps
      AND (len(b.steps) > len(a.steps) OR b.conv_id < a.conv_id))),
made AS (
  SELECT conv_id, turn, role, text,
         '<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS segment
  FROM rows JOIN kept USING (conv_id))
SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text) AS INTEGER) AS part,
       CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
       segment
FROM made""",
    "op13_prefix_trie": r"""
WITH numbers AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS steps
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
sums AS (
  SELECT conv_id, steps, conv_id - conv_id % 20 AS base, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: i::UBIGINT)),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END))) AS crc
  FROM numbers),
made AS (
  SELECT a.conv_id, list_concat(coalesce(b.steps[1:(a.crc % 4)::BIGINT], []), a.steps[(a.crc % 4)::BIGINT + 1:]) AS steps
  FROM sums a LEFT JOIN numbers b ON b.conv_id = a.base),
prefixes AS (SELECT conv_id, d, steps[1:d] AS prefix, len(steps) AS size FROM (SELECT *, unnest(range(len(steps) + 1)) AS d FROM made)),
nodes AS (
  SELECT prefix, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CASE WHEN size = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends,
         (count(*) - 1) * coalesce(len(regexp_extract_all(any_value(prefix[d].x), '[^\x20\x09-\x0D]+')), 0) AS saved
  FROM prefixes GROUP BY prefix, d),
children AS (SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix, depth)),
below AS (
  SELECT prefix[1:k] AS prefix, k AS depth, sum(CAST(n_children = 0 AS BIGINT)) AS leaves, sum(saved) AS total
  FROM (SELECT *, unnest(range(depth + 1)) AS k FROM counted) GROUP BY ALL)
SELECT a.conv_id, a.depth, up.conv_id AS parent_conv_id, a.n_convs, a.n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(total AS BIGINT) AS saved_tokens, sha256(coalesce(a.ends, '')) AS ends_sha256
FROM counted a JOIN below USING (prefix, depth) LEFT JOIN nodes up ON up.depth = a.depth - 1 AND up.prefix = a.prefix[1:a.depth - 1]""",
}
