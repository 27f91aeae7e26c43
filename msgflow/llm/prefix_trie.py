"""The trie of conversations that begin alike, with totals over its subtrees.

Turns are numbered and their prefixes digested in ranges of (conversation, turn), so a task holds a range, not a
conversation: a range gets the number of turns and the digest of those before it. A node is a distinct
prefix, known by its depth and 128 bits; the exclusive-or of the digests of (place, role, text) makes the
parent's digest that of the node less its last turn.

Subtree totals come from a centroid decomposition of the parent-edge forest. Every component has a
node, its centroid, whose subtree weighs at least half of it while no subtree below does. Removing it leaves its
children's components and the one above. The total of the centroid's part is added to the centroid and
to all nodes on the path from it to the component's top; a pair of a node and one below it is parted by
just one centroid, so every total is counted once. The weight of a node is the number of turns its members
have from it on, which is known before any rollup and at least its number of nodes. Components above
`LOCAL` in weight are split in rounds over tables, at most log2 of the total by it; lighter ones are
split further inside a task, all components of a batch in step. So neither a deep conversation nor a broad node costs
more than its rows times a logarithm.

Results for odd input: rows without a conversation id are no one's and left out; a null turn comes first;
turns that tie follow in order of a hash of role and text, equal rows are turns of their own; null role and
text are empty; long texts enter by digest and number of words; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from msgflow.llm.common import bounds, own_columns, release, whole_groups
from msgflow.operators.skew import skew_join
from msgflow.session import stage

LOCAL = 1 << 16  # weight of a component that one task takes whole
FEW = 10_000  # components whose centroids are broadcast
_PART_BITS = 33
_BLOCK = 4096  # ids joined to one piece of text before they are hashed
_WORDS = r"[^\x20\x09-\x0D]+"
_KEY = ["depth", "p1", "p2"]


def numbered_turns(conversations: DataFrame, columns: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Turns with their place in their conversation, by digest, and the stretches they lie in.

    Turns: conv, part, seq, t1, t2 and words. Stretches, one per conversation and range: conv, part, first
    (the seq of its first turn), before (turns of the conversation in earlier ranges) and n (of the whole conversation).
    A turn's place is seq - first + before.
    """
    names = {"conv": "conv_id", "turn": "turn", "role": "role", "text": "text"} | (columns or {})
    rows = own_columns(conversations, names)
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = rows.select(
        F.col("conv").cast("bigint"), F.col("turn").cast("bigint"), F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), role, text).alias("t2"), F.regexp_count(text, F.lit(_WORDS)).cast("bigint").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    ).where("conv IS NOT NULL")
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("t1"), F.col("t2"), F.col("row")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(rows.select("conv", "t1", "t2", "words", F.monotonically_increasing_id().alias("seq")), "turns")
    rows = rows.withColumn("part", F.shiftright("seq", _PART_BITS))
    counts = rows.groupBy("conv", "part").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("conv")
    before = F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return rows, counts.select("conv", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(own).alias("n"))


def prefixes(turns: DataFrame, stretches: DataFrame, base: Column | None = None, head: Column | None = None, longest_head: int = 0) -> DataFrame:
    """Every prefix of every conversation: conv, depth, p1, p2, q1, q2 (digest of the prefix less a turn), words and length.

    With `base` and `head`, expressions of conv, a conversation is rebuilt: it begins with the first `head` turns
    of conversation `base`, as far as it has them, and goes on with its own turns after its first `head`. No head is longer
    than `longest_head`. A base must be its own base.
    """
    convs = stretches.groupBy("conv").agg(F.first("n").alias("n"))
    convs = convs.select("conv", "n", (base if base is not None else F.col("conv")).alias("base"), (head if head is not None else F.lit(0)).cast("bigint").alias("head"))
    sizes = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(sizes, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_n", F.lit(0))))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    convs = stage(convs.select("conv", "base", "head", "taken", "length"), "conversations")

    rows = turns.join(stretches.join(convs, "conv"), ["conv", "part"])
    rows = rows.withColumn("place", F.col("seq") - F.col("first") + F.col("before"))

    def element(name: str, seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "depth", "t1", "t2").alias(name)

    parts = [convs.select("conv", F.lit(0).cast("bigint").alias("depth"), *[F.lit(0).cast("bigint").alias(c) for c in ("p1", "p2", "q1", "q2", "words")], "length")]
    carried = None
    if longest_head:
        first = rows.where((F.col("conv") == F.col("base")) & (F.col("place") < longest_head)).withColumn("depth", F.col("place") + 1)
        first = first.select("base", "depth", "words", element("x1", 3), element("x2", 4))
        so_far = Window.partitionBy("base").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
        first = first.select("base", "depth", "words", "x1", "x2", F.bit_xor("x1").over(so_far).alias("p1"), F.bit_xor("x2").over(so_far).alias("p2"))
        heads = convs.where("taken > 0").select("conv", "base", "taken", "length").join(first, "base").where(F.col("depth") <= F.col("taken"))
        heads = stage(heads.select("conv", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"), "words", "length", "taken"), "heads")
        parts.append(heads.drop("taken"))
        carried = heads.where(F.col("depth") == F.col("taken")).select("conv", F.col("p1").alias("h1"), F.col("p2").alias("h2"))
    own = rows.where(F.col("place") >= F.col("head")).withColumn("depth", F.col("place") - F.col("head") + F.col("taken") + 1)
    own = stage(own.select("conv", "part", "seq", "depth", "words", "length", element("x1", 3), element("x2", 4)), "own-turns")
    sums = own.groupBy("conv", "part").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    sums = sums.select("conv", "part", *[F.coalesce(F.bit_xor(f"s{k}").over(earlier), none).alias(f"e{k}") for k in (1, 2)])
    if carried is not None:
        sums = sums.join(carried, "conv", "left")
        sums = sums.select("conv", "part", *[F.col(f"e{k}").bitwiseXOR(F.coalesce(f"h{k}", none)).alias(f"e{k}") for k in (1, 2)])
    inside = Window.partitionBy("conv", "part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumns({f"i{k}": F.bit_xor(f"x{k}").over(inside) for k in (1, 2)}).join(sums, ["conv", "part"])
    p = {k: F.col(f"i{k}").bitwiseXOR(F.col(f"e{k}")) for k in (1, 2)}
    parts.append(own.select(
        "conv", "depth", *[p[k].alias(f"p{k}") for k in (1, 2)], *[p[k].bitwiseXOR(F.col(f"x{k}")).alias(f"q{k}") for k in (1, 2)], "words", "length",
    ))
    return stage(reduce(DataFrame.unionByName, parts), "prefixes")


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each node in pieces of text, from rows sorted by node and id."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = [batch.column(k).to_numpy() for k in range(3)]
        ids = batch.column(3).to_numpy()
        change = np.zeros(len(ids), np.bool_)
        for key in keys:
            change[1:] |= key[1:] != key[:-1]
        edge = [0, *np.flatnonzero(change).tolist(), len(ids)]
        cuts = [at for a, b in zip(edge[:-1], edge[1:]) for at in range(a, b, _BLOCK)] + [len(ids)]
        pieces = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(c[cuts[:-1]]) for c in (*keys, ids)] + [pa.array(pieces)], names=[*_KEY, "conv", "piece"])


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its pieces in order. Memory: a batch."""
    last = running = None
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        done = []
        for *key, _, piece in zip(*[column.to_pylist() for column in batch.columns]):
            if key != last:
                if last is not None:
                    done.append((*last, running.hexdigest()))
                last, running = key, hashlib.sha256(piece.encode())
            else:
                running.update(b"," + piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=[*_KEY, "ends_sha256"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip((*last, running.hexdigest()), kinds)], names=[*_KEY, "ends_sha256"])


def end_digests(rows: DataFrame) -> DataFrame:
    """Per node where conversations end: the digest of their ids, ascending and joined by commas. Ranges of ids are joined first."""
    order = [*_KEY, "conv"]
    ends = rows.where(F.col("depth") == F.col("length")).select(*order)
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_joined, "depth bigint, p1 bigint, p2 bigint, conv bigint, piece string")
    return pieces.repartition(*_KEY).sortWithinPartitions(*order).mapInArrow(_hashed, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def centroid_totals(comp: np.ndarray, node: np.ndarray, parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """What centroids add to each node, for whole components: the totals of all nodes below it.

    All components are split in step; ancestors at a given depth are found by doubling.
    """
    n = len(node)
    order = np.argsort(node)
    spot = np.minimum(np.searchsorted(node, parent, sorter=order), n - 1)
    found = order[spot]
    up = np.where((node[found] == parent) & (comp[found] == comp), found, n)
    lifts = [np.append(up, n)]
    while (lifts[-1] < n).any():
        lifts.append(lifts[-1][lifts[-1]])

    def lifted(start: np.ndarray, steps: np.ndarray) -> np.ndarray:
        for k, lift in enumerate(lifts):
            start = np.where(steps >> k & 1, lift[start], start)
        return start

    label = order[np.searchsorted(node, comp, sorter=order)]  # a component is named by its top
    weight, added = weight.copy(), np.zeros_like(values)
    alive, centroid = np.arange(n), np.zeros(n, np.int64)
    while len(alive):
        half = alive[2 * weight[alive] >= weight[label[alive]]]
        half = half[np.lexsort((half, weight[half], label[half]))]
        chosen = half[bounds(label[half])[:-1]]
        centroid[label[chosen]] = chosen
        own = centroid[label[alive]]
        deeper = depth[alive] - depth[own]
        child = lifted(alive, np.maximum(deeper - 1, 0))
        below = (deeper > 0) & (lifts[0][child] == own)
        path = (deeper < 0) & (lifted(own, np.maximum(-deeper, 0)) == alive)
        part = np.zeros_like(values)
        inside = below | (alive == own)
        np.add.at(part, own[inside], values[alive[inside]])
        added[chosen] += part[chosen] - values[chosen]
        above, cut = alive[path], own[path]
        added[above] += part[cut]
        weight[above] -= weight[cut]
        label[alive[below]] = child[below]
        alive = alive[alive != own]
    return added


_LIGHT = ["comp", "node", "parent", "depth", "weight", "leaves", "saved"]


def _settled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in whole_groups(batches, "comp"):
        comp, node, parent, depth, weight, leaves, saved = (rows.column(c).to_numpy() for c in _LIGHT)
        added = centroid_totals(comp, node, parent, depth, weight, np.stack([leaves, saved], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(added[:, 0]), pa.array(added[:, 1])], names=["node", "leaves", "saved"])
        release()


def subtree_totals(nodes: DataFrame, places, local: int = LOCAL) -> DataFrame:
    """`nodes` (node, parent, rep, depth, weight, leaves, saved) with leaves and saved summed over subtrees: node, leaves, saved.

    `places()` gives the table (conv, depth, node, parent) of all prefixes; it is made only when a component exceeds `local`.
    """
    root = nodes.where("depth = 0").select("node").first()
    if root is None:
        return nodes.select("node", "leaves", "saved")
    left = nodes.withColumn("comp", F.lit(root["node"]))  # one component, named by its top
    light, added, table = [], [], None
    while True:
        heavy = left.where("node = comp").where(F.col("weight") > local).select("comp", F.col("weight").alias("total"), F.col("depth").alias("top"))
        heavy = stage(heavy, "heavy")
        count = heavy.count()
        if count == 0:
            light.append(left)
            break
        table = table or places()

        def near(side: DataFrame) -> DataFrame:
            return F.broadcast(side) if count <= FEW else side

        light.append(left.join(near(heavy.select("comp")), "comp", "left_anti"))
        left = left.join(near(heavy), "comp")
        half = left.where(2 * F.col("weight") >= F.col("total"))
        centres = half.groupBy("comp").agg(F.min(F.struct("weight", "node", "depth", "rep", "top")).alias("c"))
        centres = stage(centres.select("comp", *[F.col(f"c.{name}").alias(f"c_{name}") for name in ("weight", "node", "depth", "rep", "top")]), "centroids")
        left = left.drop("total", "top").join(near(centres), "comp")
        # The nodes below a centroid are those whose prefix, cut to its depth and one turn more, is a child of it.
        deeper = left.where(F.col("depth") > F.col("c_depth")).withColumn("spot", F.struct(F.col("rep").alias("conv"), (F.col("c_depth") + 1).alias("depth")))
        lookup = table.select(F.struct("conv", "depth").alias("spot"), F.col("node").alias("child"), F.col("parent").alias("of"))
        deeper = stage(skew_join(deeper, lookup, "spot", ["node"]).drop("spot"), "deeper")
        below = F.col("of").eqNullSafe(F.col("c_node"))
        path = table.select(F.col("conv").alias("c_rep"), F.col("depth").alias("at"), "node").join(near(centres), "c_rep")
        path = path.where((F.col("at") >= F.col("c_top")) & (F.col("at") < F.col("c_depth")))
        path = stage(path.select("node", "comp", "c_weight"), "path")
        centre = left.where(F.col("node") == F.col("c_node"))
        inner = deeper.where(below).select("comp", "leaves", "saved").unionByName(centre.select("comp", "leaves", "saved"))
        part = inner.groupBy("comp").agg(F.sum("leaves").alias("part_leaves"), F.sum("saved").alias("part_saved"))
        gained = centre.join(part, "comp").select("node", (F.col("part_leaves") - F.col("leaves")).alias("leaves"), (F.col("part_saved") - F.col("saved")).alias("saved"))
        added.append(stage(gained.unionByName(path.join(part, "comp").select("node", F.col("part_leaves").alias("leaves"), F.col("part_saved").alias("saved"))), "added"))
        names = nodes.columns
        moved = deeper.where(below).select(*names, F.col("child").alias("comp"))
        others = deeper.where(~below).select(*names, "comp").unionByName(
            left.where((F.col("depth") <= F.col("c_depth")) & (F.col("node") != F.col("c_node"))).select(*names, "comp")
        )
        others = others.join(path.select("node", "c_weight"), "node", "left").withColumn("weight", F.col("weight") - F.coalesce("c_weight", F.lit(0))).drop("c_weight")
        left = stage(moved.unionByName(others.select(*names, "comp")), "components")
    rest = reduce(DataFrame.unionByName, [part.select(*_LIGHT) for part in light])
    rest = rest.repartition("comp").sortWithinPartitions("comp", "depth").mapInArrow(_settled, "node bigint, leaves bigint, saved bigint")
    own = nodes.select("node", "leaves", "saved")
    every = reduce(DataFrame.unionByName, [own, rest, *added])
    return every.groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def prefix_trie(rows: DataFrame, local: int = LOCAL) -> DataFrame:
    """Every node of the trie of `prefixes`: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    found = rows.groupBy(*_KEY).agg(
        F.min("conv").alias("rep"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
        F.max("q1").alias("q1"), F.max("q2").alias("q2"),
    )
    found = stage(found.withColumn("node", F.monotonically_increasing_id()), "nodes")
    below = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    nodes = found.join(below, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    above = found.select(F.struct(*_KEY).alias("key"), F.col("node").alias("parent"), F.col("rep").alias("parent_rep"))
    up = F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")))
    nodes = skew_join(nodes.withColumn("key", up), above, "key", ["node"]).drop("key")
    nodes = stage(nodes, "trie")

    def places() -> DataFrame:
        known = nodes.select(F.struct(*_KEY).alias("key"), "node", "parent")
        return stage(skew_join(rows.select("conv", "depth", F.struct(*_KEY).alias("key")), known, "key", ["conv"], "inner").drop("key"), "places")

    forest = nodes.select(
        "node", F.coalesce("parent", F.lit(-1)).alias("parent"), "rep", "depth", "weight", (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    totals = subtree_totals(forest, places, local)
    ended = end_digests(rows)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(totals, "node").join(ended, _KEY, "left").select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent_rep").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
