"""Toxicity, language, Katz model and URL filter."""

import functools
import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from msgflow.llm import katz, language, queries, toxicity, url_filter


def test_toxicity_on_held_out_rows(spark):
    found = queries.op5_toxicity(spark, "/root/testdata/sf0.1").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("toxic IS NOT NULL")
    rows = found.join(labels, "doc_id").select("predicted", "toxic").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)


def test_toxicity_of_odd_texts():
    rng = random.Random(0)
    words = ["".join(rng.choice("abcdeo") for _ in range(5)) for _ in range(50)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(200)]
    toxic = [i % 4 == 0 for i in range(200)]
    texts = [t.replace(" ", " scoundrel ", 1) if y else t for t, y in zip(texts, toxic)]
    model = toxicity.train_model(texts, [int(y) for y in toxic])
    clean = " ".join(rng.choices(words, k=4000))
    scores = model.score(pa.array(["", None, "  \n", clean, clean + " scoundrel", "you scoundrels", clean[:300] + " Scoundrel"]))
    assert scores[0] == scores[1] == scores[2] and (scores[:4] < 0.5).all() and (scores[4:] >= 0.5).all()
    assert model.score(pa.array([], pa.string())).tolist() == []
    assert toxicity.train_model(["a", "b"], [0, 0]).score(pa.array(["x"]))[0] == 0
    assert toxicity.train_model([], []).score(pa.array(["x"]))[0] == 0


def phrases(text, trained):
    """Longest matches one after the other; a block starts anew; a character that never occurs is a phrase."""
    count = 0
    for start in range(0, len(text), language.BLOCK):
        block, i = text[start : start + language.BLOCK], 0
        while i < len(block):
            n = 1
            while i + n <= len(block) and block[i : i + n] in trained:
                n += 1
            i += max(1, n - 1)
            count += 1
    return count


def test_phrases_equal_brute_force():
    rng = random.Random(5)
    samples = {k: "".join(rng.choice(alphabet) for _ in range(800)) for k, alphabet in (("a", "abc d"), ("b", "bcde "), ("c", "xyz"))}
    model = language.train_model(samples)
    texts = ["", "q", "abc" * 500] + ["".join(rng.choice("abcdexyz q") for _ in range(rng.randint(1, 2000))) for _ in range(30)]
    found = model.phrases([model.codes(t) for t in texts])
    assert found.tolist() == [[phrases(t, samples[k]) for k in model.languages] for t in texts]


def test_languages_of_many_alphabets():
    rng = random.Random(9)

    def speaker(letters):  # own frequent words over an alphabet
        words = ["".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(150)]
        return lambda n: " ".join(rng.choices(words, k=n))

    latin, accents, cyrillic = "abcdefghijklmnopqrstuvwxyz", "àâäçèéêëîïñòóôöùúûüßœæåøšž", "абвгдежзийклмнопрстуфхцчшщъыьэюяіїєґ"
    chinese, hangul = ([chr(first + i) for i in range(1500)] for first in (0x4E00, 0xAC00))
    alphabets = {"l1": latin, "l2": latin + accents, "c1": cyrillic, "c2": cyrillic, "z1": chinese, "z2": chinese, "h1": hangul, "h2": hangul, "x": [chr(0x20000 + i) for i in range(200)]}
    speakers = {k: speaker(v) for k, v in alphabets.items()}
    samples = {k: language.normalised(speak(3000))[:4000] for k, speak in speakers.items()}
    model = language.train_model(samples)
    texts = [(k, language.normalised(speak(12))) for k, speak in speakers.items() for _ in range(5)] + [("", "".join(rng.choices("абв 一丁丂q", k=700)))]
    assert [found for found, (k, _) in zip(model.predict([t for _, t in texts])[0], texts) if k] == [k for k, _ in texts if k]
    assert model.phrases([model.codes(t) for _, t in texts]).tolist() == [[phrases(t, samples[k]) for k in model.languages] for _, t in texts]
    assert model.owner.nbytes + model.target.nbytes < 3_000_000  # grows with the samples, not with the alphabets


def test_language_of_odd_texts(spark):
    docs = [(i, "the cat and the dog were there with them " * 3 + str(i), "en") for i in range(30)]
    docs += [(100 + i, "der hund und die katze waren nicht da " * 3 + str(i), "de") for i in range(30)]
    learn = spark.createDataFrame([*docs, (500, None, "fr"), (501, "123", "xx"), (502, "what is this", None)], "doc_id bigint, text string, lang string")
    model = language.train_model(language.training_samples(learn, F.lit(True)))
    assert model.languages == ["de", "en"]
    odd = [(1, None, 0), (2, "", 0), (3, "12 34 !!", 0), (4, "the dog", 0), (5, "die katze " * 20_000, 0), (None, "the dog", 0), (4, "the dog", 0)]
    found = language.identify(spark.createDataFrame(odd, "doc_id bigint, text string, lang_pred int"), model).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in found) == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "de")]
    assert all(0 <= r["score"] <= 1 for r in found)
    none = language.train_model(language.training_samples(learn.where("false"), F.lit(True)))
    assert none.predict(["the dog"])[0] == ["und"]


def test_every_label_is_learned_and_none_changes_another(spark):
    rows = [(i, f"word{chr(97 + i % 26)} of {'abcdefghij'[i // 30]}{chr(97 + i % 30)} text " * 3, f"l{i:03d}") for i in range(300)]
    rows += [(1000 + i, f"the cat and the dog number {i} were there " * 20, "en") for i in range(50)]
    learn = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    samples = language.training_samples(learn, F.lit(True), chars=2_000)
    assert len(samples) == 301 and 1_900 <= len(samples["en"]) <= 2_000
    assert len({s for s in samples["en"].split() if s in ("cat", "dog", "were")}) == 3
    tiny = learn.unionByName(spark.createDataFrame([(9999, "un mot", "fr")], learn.schema))
    assert language.training_samples(tiny, F.lit(True), chars=2_000) == samples | {"fr": "un mot"}
    model = language.train_model({**samples, "fr": "un mot"})
    assert model.predict(["the dog and the cat were there", "un mot un mot"])[0] == ["en", "fr"]


def test_stretches_use_up_what_is_asked_for():
    for lengths, chars in ([10, 10, 10], 15), ([1, 2, 100], 50), ([5], 3), ([3, 3], 100), ([], 9), ([1, 1, 8, 8], 12):
        cut = [min(n, language.stretch_of(lengths, chars)) for n in lengths]
        assert min(sum(lengths), chars) <= sum(cut) < min(sum(lengths), chars) + max(1, len(lengths))


def test_language_on_held_out_rows(spark):
    found = queries.op7_language(spark, "/root/testdata/sf0.1").where("held_out")
    rows = found.join(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL")
    assert rows.where("lang = lang_pred").count() >= 0.98 * rows.count()


def slow_katz(docs, learned, order):
    def tokens(text):
        return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in __import__("re").findall(r"[^\x20\x09-\x0d]+", text or "")] + [" "]

    counts, texts = [Counter() for _ in range(order + 1)], 0
    for (_, text), train in zip(docs, learned):
        if train:
            texts += 1
            words = ["  ", *tokens(text)]
            counts[1].update((w,) for w in words[1:])
            for k in range(2, order + 1):
                counts[k].update(zip(*[words[i:] for i in range(k)]))
    total, types = sum(counts[1].values()), len(counts[1])
    slopes = [None] + [katz.fitted_slope([sum(c == r for c in found.values()) for r in range(1, katz.SPECTRUM + 1)]) for found in counts[1:]]
    followers = defaultdict(list)
    for found in counts[2:]:
        for gram in found:
            followers[gram[:-1]].append(gram[-1])

    def star(k, r):
        return r * (1 + 1 / r) ** (slopes[k] + 1)

    unknown = 1 - sum(star(1, c) for c in counts[1].values()) / total if total else 1.0

    def count(history):
        return texts if history == ("  ",) else counts[len(history)][history]

    def probability(history, word):
        k = len(history) + 1
        seen = counts[k][*history, word]
        if not history:
            return star(1, seen) / total if seen else unknown
        if seen:
            return star(k, seen) / count(history)
        return weight(history) * probability(history[1:], word)

    @functools.cache
    def weight(history):
        if not count(history):
            return 1.0
        mass = sum(star(len(history) + 1, counts[len(history) + 1][*history, w]) for w in followers[history]) / count(history)
        return (1 - mass) / (1 - sum(probability(history[1:], w) for w in followers[history]))

    rows = []
    for doc_id, text in docs:
        words = ["  ", *tokens(text)]
        score = sum(math.log10(probability(tuple(words[max(0, i - order + 1) : i]), words[i])) for i in range(1, len(words)))
        base = sum(math.log10((counts[1][w,] + 1) / (total + types + 1)) for w in words[1:])
        rows.append((doc_id, len(words) - 1, sum(counts[1][w,] > 0 for w in words[1:]), total, base, score))
    for history in [*list(followers)[:20], *list(followers)[-20:], *[("nothing",)] * (order > 1)]:  # every history sums to one over all words and the unknown class
        assert math.isclose(sum(probability(history, w) for w in [*(w for w, in counts[1]), "never seen"]), 1.0, abs_tol=1e-9)
    return rows


@pytest.mark.parametrize("size, order", [(150, 2), (2_000_000, 2), (150, 3), (150, 4), (2_000_000, 1)])
def test_katz_equals_brute_force(spark, monkeypatch, size, order):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", size)
    rng = random.Random(11)
    words = ["the", "The", "a", "cat", "sat", "ÉTÉ", "été", "x\u00a0y", "\x1c"] + [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices(words, [30] + [2] * (len(words) - 1), k=rng.randint(0, 60)))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, " \n\t "), (103, "new words only"), (104, " the  cat\nsat ")]
    learned = [i % 7 != 2 for i, _ in docs]
    frame = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id bigint, text string, score double").repartition(3)
    found = {r["doc_id"]: r for r in katz.score_texts(frame, F.col("doc_id") % 7 != 2, order=order).collect()}
    for doc_id, n, known, total, base, score in slow_katz(docs, learned, order):
        row = found[doc_id]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (n, known, total)
        assert row["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9) and row["score"] == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_katz_without_training_texts_and_without_rows(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id bigint, text string")
    assert [r["score"] for r in katz.score_texts(frame, F.lit(False)).collect()] == [0.0, 0.0, 0.0]
    assert katz.score_texts(frame.where("false"), F.lit(True)).count() == 0


def test_url_parts_and_rules(spark):
    urls = [None, "", "no scheme/x", "HTTP://A.Example.NET/en/x?q#f", "http://net/x", "http://x.net", "http://anet/en/", "http://example.com/de/y", "https://ex.org/fr/", "a://b://c/d", "http://É.org/fr\n?x", "http://EXAMPLE.net/en?x/"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("host", F.lit("clash"))
    found = {r["page_id"]: r for r in url_filter.judge_urls(rows, queries.RULES, url_filter.UrlModel(-3.0)).collect()}

    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        path = rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        return host, path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]

    for i, url in enumerate(urls):
        host, path = parts(url)
        fits = [r for r in queries.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len, default=None)
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule)
        assert found[i]["verdict"] == (queries.RULES[rule] if rule else "allow")


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(4)

    def url(bad):
        name = "".join(rng.choice("0123456789abcdef" if bad else "aeioulmnrst") for _ in range(12))
        return f"http://{name}.{rng.choice(['one', 'two'])}.com/{'x1/' * rng.randint(0, 3) if bad else 'page'}?{'a=1&' * rng.randint(0, 5 if bad else 1)}"

    rows = [(url(i % 3 == 0), int(i % 3 == 0)) for i in range(1500)]
    model = url_filter.train_model(spark.createDataFrame(rows, "url string, blocked int"))
    test = [(i, url(i % 2 == 0)) for i in range(400)]
    found = url_filter.judge_urls(spark.createDataFrame(test, "page_id bigint, url string"), {}, model).collect()
    assert sum((r["verdict"] == "block") == (r["page_id"] % 2 == 0) for r in found) >= 380
    assert np.isfinite([r["score"] for r in found]).all()
    nothing = url_filter.train_model(spark.createDataFrame([], "url string, blocked int"))
    assert {r["verdict"] for r in url_filter.judge_urls(spark.createDataFrame(test, "page_id bigint, url string"), {}, nothing).collect()} == {"allow"}


def test_trees_keep_the_share_of_blocks_on_a_small_sample(spark):
    rng = random.Random(12)

    def url():
        return f"http://{''.join(rng.choices('abcdefgh', k=8))}.com/{''.join(rng.choices('xyz/', k=12))}"

    rows = [(i, url(), int(rng.random() < 0.2)) for i in range(12_000)]  # no signal: the share is all there is to learn
    labelled = spark.createDataFrame(rows, "page_id bigint, url string, blocked int")
    test = spark.createDataFrame([(i, url()) for i in range(1000)], "page_id bigint, url string")
    shares = {}
    for bound in (20_000, 1000):
        found = url_filter.judge_urls(test, {}, url_filter.train_model(labelled, bound)).collect()
        shares[bound] = sum(r["verdict"] == "block" for r in found) / len(found)
        assert abs(np.mean([r["score"] for r in found]) - 0.2) < 0.05
    assert abs(shares[20_000] - shares[1000]) < 0.05


def test_katz_chunk_takes_bounded_memory():
    """Two tasks of an executor hold a chunk each, beside its heap."""
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{n}" for n in rng.zipf(1.2, 2_000) % 200_000) for _ in range(1_300)]
    ids = pa.array(range(50), pa.int64())
    batches = (pa.record_batch([ids, ids, pa.array([True] * 50), pa.array(texts[n : n + 50])], names=["uid", "doc_id", "learned", "text"]) for n in range(0, 1_300, 50))
    (row,) = next(katz._chunks(batches)).to_pylist()
    tracemalloc.start()
    try:
        assert len(katz.Chunk.read(row, katz.ORDER).tokens) >= katz.CHUNK_TOKENS
        assert tracemalloc.get_traced_memory()[1] < 120 << 20
    finally:
        tracemalloc.stop()
