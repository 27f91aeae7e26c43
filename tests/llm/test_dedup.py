"""Exact, near and vector deduplication against brute force, with odd input."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from msgflow.llm import exact_dedup, queries, simhash, vector_dedup
from msgflow.llm.components import components

DOCS = "doc_id bigint, text string, uid string, digest string"


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("fan", [2, 16])
def test_exact_duplicates_equal_brute_force(spark, fan):
    rng = random.Random(fan)
    texts = ["", None, "É", "é", "Same", "sAME", " same"] + [f"text {i}" for i in range(20)] + ["long " * 50_000]
    rows = [(i, "hot" if rng.random() < 0.4 else rng.choice(texts), "x", "y") for i in range(300)] + [(None, "hot", "", ""), (7, "twice", "", ""), (7, "twice", "", "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(13)
    found = exact_dedup.exact_duplicates(docs, fan=fan).collect()
    groups = {}
    for doc_id, text, _, _ in rows:
        groups.setdefault(folded(text), []).append(doc_id)
    by_digest = {hashlib.sha256(t.encode()).digest(): ids for t, ids in groups.items()}
    assert len(found) == len(rows)
    for row in found:
        ids = by_digest[bytes(row["digest"])]
        assert row["group_size"] == len(ids)
        assert row["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = [bytes(r["digest"]) for r in found if r["kept"]]
    assert sorted(kept) == sorted(by_digest)  # exactly one row of each text, also where ids are equal
    assert exact_dedup.exact_duplicates(docs.where("false")).count() == 0


def test_exact_duplicates_can_keep_the_smallest(spark):
    docs = spark.createDataFrame([(3, "a"), (1, "A"), (2, "b")], "doc_id bigint, text string")
    found = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_duplicates(docs, keep="smallest").collect()}
    assert found == {3: 1, 1: 1, 2: 2}


def slow_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", folded(text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "   \n", "One", "one two", "a b c d", "É é\u00a0x\x1cy  z\tw", "w " * 70_000, "the cat sat on the mat " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def test_links_keep_all_components_of_near_fingerprints(spark):
    rng = random.Random(3)
    points = {0, (1 << 64) - 1}
    for size in (1, 3, 40, 400):  # the last ones crowd a grid point
        centre = rng.getrandbits(64)
        for _ in range(size):
            point = centre
            for _ in range(rng.randint(0, 3)):
                point ^= 1 << rng.randrange(12 if size == 400 else 64)
            points.add(point)
    points |= {rng.getrandbits(64) for _ in range(50)}
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    links = [(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= 2]
    expected = roots_of(points, links)
    found = components(simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp bigint"))).collect()
    classes = {r["node"] % (1 << 64): r["root"] for r in found}
    by_root = {}
    for point in points:
        by_root.setdefault(expected[point], set()).add(classes.get(point, point - (1 << 64) if point >> 63 else point))
    assert all(len(c) == 1 for c in by_root.values())
    assert len({next(iter(c)) for c in by_root.values()}) == len(by_root)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(5, None, "", ""), (3, "", "", ""), (None, "  ", "", ""), (9, "some words here", "", ""), (8, "Some  words\nhere", "", ""), (8, "Some words here", "", ""), (4, "other text", "", "")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in found) == [(0, 3), (3, 3), (4, 4), (5, 3), (8, 8), (8, 8), (9, 8)]
    assert len([r for r in found if r["uid"] == r["keep_uid"]]) == 3
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2060)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: r for n, r in roots_of(linked, links).items()}


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        centre = rng.standard_normal(32)
        for _ in range(rng.integers(1, 6)):
            noise = rng.standard_normal(32) * rng.uniform(0, 0.18) if i % 3 else rng.standard_normal(32) * 0.02
            rows.append((len(rows), (centre + noise).tolist(), int(i % 2)))
    crowd = rng.standard_normal(32)  # more than two blocks
    rows += [(len(rows) + i, (crowd + rng.standard_normal(32) * 0.01).tolist(), 0) for i in range(1200)]
    rows += [(len(rows) + i, [1.0] * 32, 1) for i in range(5)] + [(len(rows) + 5 + i, [2.0] * 32, 1) for i in range(2)]
    first_odd = len(rows)
    odd = [None, [], [0.0] * 32, [math.nan] + [1.0] * 31, [math.inf] + [1.0] * 31, [None] + [1.0] * 31, [1.0] * 31]
    rows += [(first_odd + i, v, 1) for i, v in enumerate(odd)] + [(first_odd + 20, [1.0] * 32, None)]
    found = {r["vec_id"]: r for r in vector_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()}
    plain = [(i, np.array(v, np.float32).astype(float), label) for i, v, label in rows[:first_odd]]
    unit = np.stack([v / np.linalg.norm(v) for _, v, _ in plain])
    labels = np.array([label for _, _, label in plain])
    linked = (unit @ unit.T >= 0.98 + 1e-12) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    got = np.array([found[i]["n_links"] for i in range(first_odd)])
    assert got.sum() >= 0.999 * linked.sum() and (got <= linked.sum(axis=1)).all()
    roots = roots_of(range(first_odd), np.argwhere(linked).tolist())
    assert sum(found[i]["component_id"] != roots[i] for i in range(first_odd)) <= 1
    for i in range(first_odd, len(rows) - 1):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert found[first_odd + 20]["n_links"] == 0


def test_meetings_carry_codes_and_vectors_go_where_they_are_undecided(spark, monkeypatch):
    rng = np.random.default_rng(5)
    near = rng.standard_normal(48)
    rows = [(i, (near + rng.standard_normal(48) * 0.02).tolist(), 1) for i in range(40)]
    rows += [(100 + i, rng.standard_normal(48).tolist(), 1) for i in range(400)]
    rows += [(1000, None, 1)]
    seen = {}

    def stage(df, label, path=None, plain=vector_dedup.stage):
        seen[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return plain(df, label, path)

    monkeypatch.setattr(vector_dedup, "stage", stage)
    monkeypatch.setattr(vector_dedup, "BLOCK", 8)  # blocks that meet blocks
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("code", F.lit("x")).withColumn("factor", F.lit(1))
    found = {r["vec_id"]: r for r in vector_dedup.near_duplicate_vectors(table).collect()}
    taken = {label: [line for line in plan.splitlines() if "Project [" in line] for label, plan in seen.items()}
    assert not any("vector#" in line for line in taken["undecided"]) and any("vector#" in line for line in taken["compared"])
    assert [found[i]["n_links"] for i in range(40)] == [39] * 40 and {found[i]["component_id"] for i in range(40)} == {0}
    assert all(found[i]["n_links"] == 0 for i in found if i >= 100)
    assert vector_dedup.near_duplicate_vectors(table.where("false")).count() == 0


def test_stored_codes_give_back_their_signs():
    rng = np.random.default_rng(6)
    for size in (3, 64, 700):
        signs, _ = vector_dedup.encode(vector_dedup._unit(rng.standard_normal((9, size))))
        codes = [code.tobytes() for code in vector_dedup.packed_signs(signs)]
        assert (vector_dedup.unpacked_signs(codes, size) == signs).all()


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(7)
    x = vector_dedup._unit(rng.standard_normal((300, 64)))
    estimate, error = vector_dedup.estimates(*vector_dedup.encode(x), x)
    difference = estimate - x @ x.T
    off = ~np.eye(300, dtype=bool)
    assert abs(difference[off].mean()) < 0.002 and (np.abs(difference) <= error)[off].mean() > 0.999


def test_registered_vectors_recall(spark):
    found = queries.op9_vector_dedup(spark, "/root/testdata/sf0.1").toPandas().sort_values("vec_id")
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas().sort_values("vec_id")
    unit = np.stack(rows["embedding"]).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.98) & (rows["label"].values[:, None] == rows["label"].values[None, :])
    np.fill_diagonal(linked, False)
    assert found["n_links"].sum() >= 0.99 * linked.sum()
