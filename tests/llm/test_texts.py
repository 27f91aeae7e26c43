"""Packing, pieces, chat formatting, the pipeline and the registered SQL."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from msgflow.llm import chat_format, packing, pieces, queries
from tests.compare import connect, difference

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "\n", "Hello, World!", "don't  stop\t\u00a0now", "É́é e\u0301 ΣΑΣ İ", "漢字 𝔘", "<|endoftext|> x", "y <|EndOfText|><|startoftext|>z\n<|startoftext|", "word " * 9000, "a\x85b\u2028c", "x.\ny,z!! it's 12,5"]


def test_word_ids_equal_the_tokenizer(spark):
    tokenizer = Tokenizer.from_file(WORDS)
    rng = random.Random(0)
    texts = ODD + ["".join(rng.choice("abcABC ,.'!\né1") for _ in range(rng.randint(1, 80))) for _ in range(200)]
    import pyarrow as pa

    found = [ids.tolist() for ids in packing.WordTokenizer(WORDS).encode(pa.array(texts))]
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("buffer", [3000, 1 << 19])
def test_packing_round_trip(spark, buffer):
    tokenizer = Tokenizer.from_file(WORDS)
    rng = random.Random(1)
    texts = ODD + ["the cat " * rng.randint(0, 900) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, start int").repartition(2)
    rows = packing.pack_documents(docs, WORDS, buffer_tokens=buffer).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padded = 0
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and at == found[0]["sequence_tokens"]
        padded += at & (at - 1) != 0
    assert padded <= 2  # one per task
    steps = defaultdict(set)
    for r in rows:
        steps[r["step_group"]].add((r["sequence_id"], r["sequence_tokens"]))
    assert sum(t for s in steps.values() for _, t in s) == sum(r["length"] for r in rows)


def test_packing_of_no_rows_and_equal_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id bigint, text string")
    assert packing.pack_documents(docs.where("false"), WORDS).count() == 0
    assert sorted((r["doc_id"] or 0, r["length"]) for r in packing.pack_documents(docs.coalesce(1), WORDS).collect()) == [(0, 2), (1, 3), (1, 3)]


def test_step_groups_are_balanced():
    rng = random.Random(2)
    tokens = [rng.choice([256, 512, 1024, 2048]) for _ in range(500)]
    load = np.bincount(packing.step_groups(tokens, 1 << 15), tokens)
    assert load.max() - load.min() <= 256 and len(load) > 5


def test_pieces_equal_the_sequential_scan(spark):
    model = pieces.PieceModel.shared(PIECES)
    rng = random.Random(3)
    texts = [t for t in ODD if t is None or len(t) < 5000] + ["x" * 400, "  a  b ", "漢字 " * 30]
    texts += ["".join(rng.choice("abcdetho  é\n漢") for _ in range(rng.randint(1, 300))) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, ids int")
    for chars in (16, 50, pieces.CHUNK_CHARS):
        encoded = pieces.encode_pieces(docs, PIECES, chunk_chars=chars)
        found, decoded = defaultdict(dict), defaultdict(dict)
        for r in encoded.collect():
            found[r["doc_id"]][r["chunk"]] = r
        for r in pieces.decode_pieces(encoded, PIECES).collect():
            decoded[r["doc_id"]][r["chunk"]] = bytes(r["bytes"])
        for i, text in enumerate(texts):
            rows = [found[i][k] for k in sorted(found[i])]
            ids = [x for r in rows for x in r["ids"]]
            expected = model.segment(pieces.MARK + text.replace(" ", pieces.MARK)) if text else []
            assert ids == expected and sum(r["score"] for r in rows) == model.score(np.array(expected, np.int64))
            assert sum(r["n_chars"] for r in rows) == len(text or "")
            assert b"".join(decoded[i][k] for k in sorted(decoded[i])) == ((" " + text).encode() if text else b"")
    assert pieces.encode_pieces(docs.where("false"), PIECES).count() == 0


def test_pieces_find_the_best_segmentation():
    model = pieces.PieceModel.shared(PIECES)

    def best(text):
        if not text:
            return 0
        return max(model.pieces.get(text[:n], (model.penalty if n == 1 else pieces.NONE, 0))[0] + best(text[n:]) for n in range(1, min(len(text), model.reach) + 1))

    for text in ["▁there", "▁the漢", "ab\nc", "▁▁x"]:
        assert model.score(np.array(model.segment(text))) == best(text)


def logs(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_snapshots_collapse_to_the_longest(spark):
    full = [("user", "hi"), ("assistant", "hello <|im_end|>"), ("user", None), (None, "")]
    rows = [(c, t, r, x) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for t, (r, x) in enumerate(full[:n])]
    rows += [(5, 10, "user", "hi"), (5, 11, "assistant", "other"), (6, 0, "user", "hello")]  # numbering starts anywhere
    found = chat_format.format_chats(logs(spark, rows)).collect()
    texts = defaultdict(str)
    for r in sorted(found, key=lambda r: (r["conv_id"], r["start"])):
        assert r["start"] == len(texts[r["conv_id"]])
        texts[r["conv_id"]] += r["segment"]
    assert set(texts) == {2, 5, 6}
    assert texts[2] == (
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello < |im_end|><|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>unknown\n<|im_end|>\n"
    )


def test_snapshots_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "BLOCK", 3)  # many blocks and blocks of blocks
    long = [(1, t, "user", f"t{t % 5}") for t in range(40)]
    prefix = [(2, t, "user", f"t{t % 5}") for t in range(25)]
    other = [(3, t, "user", f"t{t % 5}" if t != 12 else "x") for t in range(25)]
    nulls = [(None, None, "user", "a"), (None, 0, "user", "b"), (4, 0, "user", "b"), (4, 0, "user", "b"), (5, 0, "user", "b")]
    found = chat_format.maximal_conversations(chat_format.turns(logs(spark, long + prefix + other + nulls))).collect()
    assert {r["conv_id"]: (r["is_prefix"], r["kept"], r["n_rows"]) for r in found} == {
        1: (False, True, 40), 2: (True, False, 25), 3: (False, True, 25), None: (False, True, 2), 4: (False, True, 2), 5: (False, True, 1)
    }
    assert chat_format.format_chats(logs(spark, long).where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    connection = connect("/root/testdata/sf0.001")
    assert difference(entry.queries()[name](spark, "/root/testdata/sf0.001"), connection, queries.SQL[name]) is None


def test_pipeline_keeps_one_clean_document_of_each(spark, tmp_path):
    rng = random.Random(6)
    syllables = ["the", "er", "in", "on", "at", "ti", "re", "ed"]

    def prose(n):
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))

    clean = [prose(120) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100 + i, clean[i].upper()) for i in range(10)]  # equal when folded
    rows += [(200 + i, clean[i].replace(" ", "  ")) for i in range(5)]  # equal words
    rows += [(300 + i, prose(30) + " scoundrel " + prose(30)) for i in range(40)]
    rows += [(400, None), (401, ""), (402, "12 34")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(300 <= i < 400)) for i, _ in rows if i < 100 or 300 <= i < 400]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert len(kept) == 40
    assert {i if i < 100 else i % 100 for i in kept} == set(range(40))
    before = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, before, str(tmp_path)).columns == before.columns
        assert function(spark, before.where("false"), str(tmp_path)).count() == 0


@pytest.mark.parametrize("stage", ["exact_dedup", "simhash"])
def test_stages_drop_the_same_rows_however_files_are_split(spark, tmp_path, stage):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["an", "be", "co", "di"], k=30)) for _ in range(60)] + ["hot text"] * 40 + [None, "", ""]
    rows = [(i // 2 if i % 5 else None, t, "row", i, "rowfile") for i, t in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string, uid int, rowfile string")
    docs.repartition(6).write.parquet(f"{tmp_path}/docs")
    function, found = dict(corpus_pipeline.STAGES)[stage], []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("134217728", "3000"):
        made = function(spark, spark.read.parquet(f"{tmp_path}/docs"), "")  # verdicts are ready, rows are not yet read
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000" if size != "3000" else "134217728")
        assert made.columns == docs.columns
        found.append(sorted(made.collect(), key=lambda r: r["uid"]))
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    kept = [[(r["doc_id"], r["text"]) for r in rows] for rows in found]
    assert sorted(kept[0], key=str) == sorted(kept[1], key=str)
    assert sorted({(t or "").lower() for t in texts}) == sorted((r["text"] or "").lower() for r in found[0])
    assert all(r["row"] == "row" and r["rowfile"] == "rowfile" for r in found[0])


def test_registered(spark):
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names
