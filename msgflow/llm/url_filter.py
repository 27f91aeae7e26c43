"""URL filter: rules first, then gradient-boosted trees on lexical features.

A rule is a host and a path prefix; it fits the host and its subdomains, and the longest rule
that fits decides. All other URLs go to boosted trees over length, depth, digit share, entropy,
parameter counts and statistics of the host's suffix (its last two labels). Suffix statistics
are counts over all labelled URLs, held in a fixed number of hash buckets, so they stay bounded.
The trees are fitted in numpy on a bounded sample of labelled URLs (`TRAIN_ROWS`), each of which counts
for as many labelled URLs as its label has for one in the sample: the share of blocks stays the true one.

Results for odd input: null URLs and URLs without `://` have an empty host and path, meet no
rule and are judged by the trees like others; repeated rows are judged alike; without labelled
URLs of both kinds the trees allow everything if none is blocked, and else block with that
share; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import bounded_sample, own_columns, release

TRAIN_ROWS = 20_000  # of each label; further labelled URLs only enter the suffix statistics
SUFFIX_BUCKETS = 4096
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.1
SMOOTHING = 20.0
_SEED = 41

FEATURES = (
    "length", "host_length", "path_length", "host_labels", "path_depth", "digit_share", "host_digits", "hyphens", "longest_label",
    "host_entropy", "path_entropy", "parameters", "parameter_length", "has_fragment", "is_secure", "odd_characters", "suffix_count", "suffix_rate",
)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z folded; empty without it."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # the longest is tried first: it comes last here
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def suffix_bucket(host: Column) -> Column:
    """Hash bucket of the last two labels of a host."""
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -2)), F.lit(SUFFIX_BUCKETS)).cast("int")


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def lexical(url: str | None, host: str, path: str) -> list[float]:
    """All features but the two of the suffix."""
    url = url or ""
    query = url.partition("#")[0].partition("?")[2]
    parameters = [p for p in query.split("&") if p]
    digits = sum(c.isdigit() for c in url)
    return [
        len(url), len(host), len(path), host.count(".") + bool(host), len([p for p in path.split("/") if p]), digits / max(1, len(url)),
        sum(c.isdigit() for c in host), host.count("-"), max(map(len, host.split("."))), _entropy(host), _entropy(path),
        len(parameters), len(query), "#" in url, url.startswith("https"), len(re.findall(r"[^\w./:?&=#-]", url)),
    ]


@dataclass
class Tree:
    """A complete tree: node k has children 2k+1 and 2k+2; a feature below 0 sends everything left."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        for _ in range(int(math.log2(len(self.leaf)))):
            feature = self.feature[node]
            right = (feature >= 0) & (rows[np.arange(len(rows)), feature] > self.cut[node])
            node = 2 * node + 1 + right
        return self.leaf[node - len(self.feature)]


@dataclass
class UrlModel:
    bias: float
    trees: list[Tree] = field(default_factory=list)
    counts: np.ndarray = field(default_factory=lambda: np.zeros((2, SUFFIX_BUCKETS)))  # per half of the labelled URLs
    blocked: np.ndarray = field(default_factory=lambda: np.zeros((2, SUFFIX_BUCKETS)))

    def suffix_features(self, buckets: np.ndarray, half: np.ndarray | None = None) -> np.ndarray:
        """Count and smoothed block rate of the suffix.

        For training, statistics come from the half a URL is not in (scaled to the whole), so no label meets itself.
        """
        if half is None:
            counts, blocked = self.counts.sum(axis=0)[buckets], self.blocked.sum(axis=0)[buckets]
        else:
            counts, blocked = 2 * self.counts[1 - half, buckets], 2 * self.blocked[1 - half, buckets]
        rate = self.blocked.sum() / max(1.0, self.counts.sum())
        return np.stack([np.log1p(counts), (blocked + SMOOTHING * rate) / (counts + SMOOTHING)], axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = np.full(len(rows), self.bias)
        for tree in self.trees:
            z += tree.predict(rows)
        return 1 / (1 + np.exp(-z))


def fit_trees(rows: np.ndarray, blocked: np.ndarray, model: UrlModel, weights: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> UrlModel:
    """Logistic boosting with histograms: gain of a split from sums of weighted gradients and Hessians per bin."""
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(rows.shape[1])], axis=1)
    z = np.full(len(rows), model.bias)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        gradient, hessian = weights * (blocked - p), weights * p * (1 - p)
        inner = 2**depth - 1
        feature, cut, leaf = np.full(inner, -1), np.zeros(inner), np.zeros(inner + 1)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            choice = np.zeros(width, np.int64)
            for f in range(rows.shape[1]):
                if not len(cuts[f]):
                    continue
                spot = (node - first) * BINS + binned[:, f]
                g = np.bincount(spot, gradient, width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(spot, hessian, width * BINS).reshape(width, BINS).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                gain[(h < 2) | (all_h - h < 2)] = 0
                gain = gain[:, : len(cuts[f])]
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best):
                    best[k], choice[k], feature[first + k], cut[first + k] = top[k], at[k], f, cuts[f][at[k]]
            f = feature[node]
            right = (f >= 0) & (rows[np.arange(len(rows)), f] > cut[node])
            node = 2 * node + 1 + right
        place = node - inner
        g, h = np.bincount(place, gradient, inner + 1), np.bincount(place, hessian, inner + 1)
        leaf = RATE * g / (h + 1)
        model.trees.append(Tree(feature, cut, leaf))
        z += leaf[place]
    return model


def train_model(labelled: DataFrame, rows: int = TRAIN_ROWS) -> UrlModel:
    """`labelled` has url and blocked (0 or 1); rows with a null in either are left out. The sample is drawn by page_id, or by URL without it."""
    key = F.col("page_id" if "page_id" in labelled.columns else "url").alias("key")
    known = labelled.where("url IS NOT NULL AND blocked IN (0, 1)").select("url", F.col("blocked").cast("int").alias("blocked"), key)
    known = known.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).withColumn("bucket", suffix_bucket(F.col("host")))
    known = known.withColumn("half", F.pmod(F.xxhash64(F.lit(_SEED), "url"), F.lit(2)).cast("int"))
    model = UrlModel(0.0)
    for row in known.groupBy("half", "bucket").agg(F.count("*").alias("n"), F.sum("blocked").alias("blocked")).collect():  # at most 2 x SUFFIX_BUCKETS rows
        model.counts[row["half"], row["bucket"]], model.blocked[row["half"], row["bucket"]] = row["n"], row["blocked"]
    total, blocked = model.counts.sum(), model.blocked.sum()
    if blocked in (0, total):
        model.bias = 30.0 if blocked else -30.0
        return model
    sample = bounded_sample(known.where("blocked = 0"), "key", rows, _SEED).unionByName(bounded_sample(known.where("blocked = 1"), "key", rows, _SEED))
    sample = sample.drop("key")
    found = sorted((tuple(r) for r in sample.toLocalIterator()), key=lambda r: (r[0], r[1]))
    labels = np.array([r[1] for r in found], np.float64)
    features = np.array([lexical(r[0], r[2], r[3]) for r in found], np.float64)
    features = np.concatenate([features, model.suffix_features(np.array([r[4] for r in found]), np.array([r[5] for r in found]))], axis=1)
    # All weights are one when neither label exceeds the bound; beyond that they restore the share of each label, with a mean of one.
    weights = np.where(labels == 1, blocked / max(1.0, labels.sum()), (total - blocked) / max(1.0, (1 - labels).sum()))
    model.bias = float(np.log(blocked / (total - blocked)))
    return fit_trees(features, labels, model, weights * len(weights) / weights.sum())


def judge_urls(pages: DataFrame, rules: dict[str, str], model: UrlModel, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and score (probability of a block by the trees) of every URL."""
    rows = own_columns(pages, {"page_id": id_col, "url": url_col})
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = rows.select(F.col("page_id").cast("bigint"), "url", "host", "path", suffix_bucket(F.col("host")).alias("bucket"))
    shared = pages.sparkSession.sparkContext.broadcast(model)  # trees and bucket counts: a fixed size

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [lexical(*r) for r in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))]
            suffix = shared.value.suffix_features(batch.column(4).to_numpy())
            values = np.concatenate([np.array(texts, np.float64).reshape(len(texts), -1), suffix], axis=1) if texts else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(shared.value.score(values))], names=["page_id", "host", "path", "score"])
            release()

    judged = rows.mapInArrow(scored, "page_id bigint, host string, path string, score double")
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    for rule, decided in rules.items():
        verdict = F.when(F.col("rule") == rule, decided).otherwise(verdict)
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
