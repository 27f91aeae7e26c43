"""Token files, periodic runs and the prefix trie against the library and brute force, with odd input."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from msgflow.llm import periodic_runs, prefix_trie, queries, token_files
from msgflow.llm.byte_tokens import ByteTokenizer

BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "\n", " a", "a  b", "a\n\nb", "don't I'll", "é́ ǅ Ʃx ª 漢字 𝔘", "<|endoftext|> x<|endoftext|>", "word " * 9000, "a\x85b c d e　f", "x.\ny,z!! it's 12,5"]


def library_ids(texts):
    return [found.ids for found in Tokenizer.from_file(BYTES).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([" ", "\n", "\t", "\r", "a", "Bc", "1", "'s", "'", "é", "ÿ", "ɏ", "中", " ", "　", " ", "\x85", "\x1c", "<|endoftext|>", "!", ".", "Ω", "😀", "́"]), max_size=30).map("".join), min_size=1, max_size=20))
def test_byte_ids_equal_the_library(texts):
    assert [ids.tolist() for ids in ByteTokenizer.shared(BYTES).encode(pa.array(texts))] == library_ids(texts)


def test_token_files_round_trip(spark, tmp_path):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choices("ab cdé\n", k=rng.randint(0, 300))) for _ in range(120)]
    rows = [(i if i % 9 else None, t, "x", 5) for i, t in enumerate(texts)] + [(7, "same", "", 0)] * 3
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spot string, row int").repartition(5)
    folder = f"file://{tmp_path}/ids"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    entries = token_files.write_token_files(docs, folder, lambda: BYTES, end_id=2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(e["documents"] for e in entries) == len(rows) and len(entries) > 1
    found = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((i for i, *_ in rows), key=lambda i: (i is not None, i or 0))
    expected = {}
    for (i, *_), ids in zip(rows, library_ids([t for _, t, *_ in rows])):
        expected.setdefault(i, []).append([*ids, 2])
    corpus, start, everything = token_files.TokenCorpus(folder), 0, []
    assert len(corpus) == len(rows)
    for number, r in enumerate(found):
        ids = corpus.document(number)
        assert ids.dtype == np.uint16 and ids.tolist() in expected[r["doc_id"]]
        expected[r["doc_id"]].remove(ids.tolist())
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
        start += len(ids)
        everything += ids.tolist()
    assert corpus.n_ids == start == entries[-1]["base"] + entries[-1]["ids"]
    for a, n in [(0, start), (3, 1000), (start - 5, 99), (entries[-1]["base"] - 2, 4)]:
        assert corpus.ids(a, n).tolist() == everything[a : a + n]
    folder = f"file://{tmp_path}/none"
    assert token_files.write_token_files(docs.where("false"), folder, lambda: BYTES, end_id=2) == []
    assert token_files.read_token_files(spark, folder).count() == 0 and len(token_files.TokenCorpus(folder)) == 0


def slow_runs(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(least, 2 * q):
                found.setdefault((start, length), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_runs_equal_brute_force(data):
    least = data.draw(st.sampled_from([2, 4, 12]))
    texts = []
    for _ in range(data.draw(st.integers(1, 8))):
        words = data.draw(st.lists(st.integers(0, data.draw(st.integers(0, 4))), max_size=120))
        if words and data.draw(st.booleans()):
            period, first = data.draw(st.integers(1, len(words))), data.draw(st.integers(0, len(words) - 1))
            words = [w if i < first else words[first + (i - first) % period] if first + (i - first) % period < len(words) else w for i, w in enumerate(words)]
        texts.append(words)
    borders = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    found = periodic_runs.text_runs(np.array([w for t in texts for w in t], np.int64), borders, least)
    assert [tuple(r) for r in found.tolist()] == [(s + borders[i], n, q) for i, t in enumerate(texts) for s, n, q in slow_runs(t, least)]


def expected_runs(doc_id, text, order):
    words = (text or "").encode().split()
    numbers = order(doc_id, len(words))
    words = words if numbers is None else [words[i] for i in numbers.tolist()]
    runs = slow_runs(words, 12)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_run_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    texts = [None, "", " \n", "a " * 40, "a b " * 30 + "c", "é  É x\t" * 20, "x" * 50_000, "one line here of six words\n" * 3 + "end"]
    texts += [" ".join(rng.choices("abcd", k=rng.randint(1, 400))) for _ in range(80)] + ["w " * 20_000]
    rows = [(i * 7, t, "r", "h") for i, t in enumerate(texts)] + [(None, "a b c " * 9, "", ""), (7, "a " * 40, "", ""), (7, "a " * 40, "", "")]
    spark.createDataFrame(rows, "doc_id bigint, text string, runs string, n_words string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_periodic_runs(spark, str(tmp_path))
    short = [(i, t) for i, t, *_ in rows if t is None or len(t) < 30_000 or " " not in t]
    expected = sorted((expected_runs(i, t, queries.repeated_words) for i, t in short), key=str)
    got = [tuple(r) for r in found.collect()]
    long_id = 7 * (len(texts) - 1)
    assert sorted((r for r in got if r[0] != long_id), key=str) == expected
    assert [r[1:5] for r in got if r[0] == long_id] == [(1, 0, 20_000, 1)]
    spark.read.parquet(f"{tmp_path}/documents.parquet").where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op12_periodic_runs(spark, f"{tmp_path}/none").count() == 0


def test_long_texts_are_joined_in_blocks(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_JOINED", 7)
    texts = ["", "a b", "c " * 30, None, " d e\nf ", "", "g h i j k l m"]
    words = periodic_runs.Words.of(pa.array(texts))
    digests = words.joined_digests(np.arange(len(words.starts) - 1), words.texts)
    assert digests == [hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for t in texts]


def slow_trie(rows, rebuild):
    logs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            logs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    logs = {c: [t[2:] for t in sorted(turns)] for c, turns in logs.items()}
    made = {}
    for c, turns in logs.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        made[c] = tuple(logs.get(c - c % 20, [])[:h] + turns[h:]) if rebuild else tuple(turns)
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        own = (len(members) - 1) * len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += own
    ends = {}
    for c, turns in made.items():
        ends.setdefault(turns, []).append(c)
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in nodes.items()
    )


def trie_rows():
    rng = random.Random(9)
    rows = []
    for c in range(300):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t * 2 - 3 if t else None, rng.choice(["u", None, ""]) if t else "u", rng.choice(["hello there", "x", None, "  a b\tc "]) if t else "hi all"))
    rows += [(1000, t, "u", f"turn {t // 3}") for t in range(400)] + [(1003, t, "u", f"turn {t // 3}") for t in range(250)]  # deep
    rows += [(c, t, "r", "copy of it") for c in range(2000, 2200) for t in range(3)]  # many copies
    rows += [(None, 1, "u", "nobody's"), (1400, 5, "u", "same"), (1400, 5, "u", "same"), (5001, 1, "u", "lone")]
    return rows


@pytest.mark.parametrize("rebuild, local, few", [(True, 1 << 16, 10_000), (True, 50, 10_000), (False, 20, 0)])
def test_trie_equals_brute_force(spark, monkeypatch, rebuild, local, few):
    monkeypatch.setattr(prefix_trie, "FEW", few)
    rows = trie_rows()
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int, node int").repartition(4)
    turns, stretches = prefix_trie.numbered_turns(table)
    if rebuild:
        made = prefix_trie.prefixes(turns, stretches, F.col("conv") - F.col("conv") % 20, F.crc32(F.col("conv").cast("string").cast("binary")) % 4, 3)
    else:
        made = prefix_trie.prefixes(turns, stretches)
    found = prefix_trie.prefix_trie(made, local=local).fillna(-1, ["parent_conv_id"]).collect()
    assert sorted(tuple(r) for r in found) == slow_trie(rows, rebuild)


def test_trie_of_nothing_and_of_a_conversation_without_turns(spark):
    table = spark.createDataFrame([(21, 0, "u", "gone: the head it asks for is that of no conversation")], "conv_id bigint, turn bigint, role string, text string")
    made = [prefix_trie.prefixes(*prefix_trie.numbered_turns(t), F.col("conv") - 1, F.lit(1), 3) for t in (table, table.where("false"))]
    assert [tuple(r)[:7] for r in prefix_trie.prefix_trie(made[0]).collect()] == [(21, 0, None, 1, 0, 1, 0)]
    assert prefix_trie.prefix_trie(made[1]).count() == 0


def test_centroids_of_long_chains_and_broad_nodes():
    rng = random.Random(1)
    parents = [-1] + [i - 1 if i < 3000 else rng.choice([0, i - 1, rng.randrange(i)]) for i in range(1, 6000)]
    depth, size, below = [0] * 6000, [1] * 6000, [i % 7 for i in range(6000)]
    for i in range(1, 6000):
        depth[i] = depth[parents[i]] + 1
    total = list(below)
    for i in range(5999, 0, -1):
        size[parents[i]] += size[i]
        total[parents[i]] += total[i]
    columns = [np.array(x, np.int64) for x in ([10] * 6000, [10 + 3 * i for i in range(6000)], [10 + 3 * p if p >= 0 else -1 for p in parents], depth, size)]
    added = prefix_trie.centroid_totals(*columns, np.array(below, np.int64)[:, None])
    assert (added[:, 0] + np.array(below)).tolist() == total
