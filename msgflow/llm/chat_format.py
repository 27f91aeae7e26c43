"""Chat formatting with collapse of cumulative snapshots, in DataFrame functions only.

Logs often hold a conversation once per turn, each time with all turns so far. A
conversation is dropped when its turns are the first turns of a longer one; of equal ones the
one with the smallest id stays. The digest of the first turns is the exclusive-or of hashes of
(position, role, text), which is associative: prefixes are scanned in blocks of positions, so
no task needs a whole conversation, however long. Prefix digests of longer conversations are
reduced to distinct ones before the anti-join, so a first turn that many share is one row.

Rendering gives each turn its own segment with its place in the conversation's text; the text
is their concatenation in order.

Results for odd input: positions count from a conversation's lowest turn; a null turn comes
first of all; null text and role are empty and `unknown`; rows with one conversation and turn
follow in order of role and text, and equal rows are all rendered and all count; rows with a null
conversation id form one conversation; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from msgflow.llm.common import own_columns
from msgflow.session import stage

BLOCK = 4096  # positions scanned in one task
START, END = "<|im_start|>", "<|im_end|>"  # the marks of the format; neutralised in texts


def _scan(rows: DataFrame, values: dict[str, tuple[str, bool]]) -> DataFrame:
    """Inclusive prefixes of associative, commutative sums over `position` within `conv`, one row per position.

    `values` maps the name of a prefix to its column and whether it is an exclusive-or (else
    a sum). Three levels: inside a block, over the blocks of a block of blocks, and over those.
    """
    sums = {name: (F.bit_xor if xor else F.sum) for name, (_, xor) in values.items()}
    base = rows.withColumn("_b1", F.floor(F.col("position") / BLOCK)).withColumn("_b2", F.floor(F.col("position") / (BLOCK * BLOCK)))
    sums1 = base.groupBy("conv", "_b2", "_b1").agg(*[sums[name](column).alias(name) for name, (column, _) in values.items()])
    sums2 = sums1.groupBy("conv", "_b2").agg(*[sums[name](name).alias(name) for name in values])
    inside = Window.partitionBy("conv", "_b1").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    before1 = Window.partitionBy("conv", "_b2").orderBy("_b1").rowsBetween(Window.unboundedPreceding, -1)
    before2 = Window.partitionBy("conv").orderBy("_b2").rowsBetween(Window.unboundedPreceding, -1)
    sums1 = sums1.select("conv", "_b1", *[sums[name](name).over(before1).alias(f"_1{name}") for name in values])
    sums2 = sums2.select("conv", "_b2", *[sums[name](name).over(before2).alias(f"_2{name}") for name in values])
    joined = base.withColumns({f"_0{name}": sums[name](column).over(inside) for name, (column, _) in values.items()})
    joined = joined.join(sums1, ["conv", "_b1"]).join(sums2, ["conv", "_b2"])

    def total(name: str, xor: bool) -> Column:
        parts = [F.coalesce(F.col(f"_{level}{name}"), F.lit(0).cast("bigint")) for level in range(3)]
        return parts[0].bitwiseXOR(parts[1]).bitwiseXOR(parts[2]) if xor else parts[0] + parts[1] + parts[2]

    return joined.select(*rows.columns, *[total(name, xor).alias(name) for name, (_, xor) in values.items()])


def turns(conversations: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """conv_id, conv (a key that is never null), position, turn, role, text and n (equal rows), one row per distinct row."""
    names = {"conv_id": "conv_id", "turn": "turn", "role": "role", "text": "text"} | (columns or {})
    rows = own_columns(conversations, names).select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    rows = rows.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    lowest = rows.groupBy("conv").agg(F.min("turn").alias("lowest"))
    return rows.join(lowest, "conv").withColumn("position", F.coalesce(F.col("turn") - F.col("lowest") + 1, F.lit(0))).drop("lowest")


def maximal_conversations(rows: DataFrame) -> DataFrame:
    """Of `turns`, every conversation with whether it is kept: conv, conv_id, n_rows, copies, is_prefix and kept."""
    hashes = [F.bit_xor(F.xxhash64(F.lit(seed), "position", "role", "text", "n")).alias(f"h{seed}") for seed in (1, 2)]
    steps = rows.groupBy("conv", "position").agg(F.sum("n").alias("n"), *hashes, F.min("conv_id").alias("conv_id"))
    prefixes = _scan(stage(steps, "steps"), {"p1": ("h1", True), "p2": ("h2", True), "n_rows": ("n", False)})
    prefixes = stage(prefixes.select("conv", "conv_id", "position", "n_rows", "p1", "p2"), "prefixes")
    last = prefixes.groupBy("conv").agg(F.max_by(F.struct("conv_id", "position", "n_rows", "p1", "p2"), "position").alias("last")).select("conv", "last.*")
    key = ["position", "n_rows", "p1", "p2"]
    ends = last.select("conv", F.col("position").alias("end"))
    proper = prefixes.join(ends, "conv").where("position < end").select(*key).distinct()
    classes = last.groupBy(*key).agg(F.min(F.struct(F.col("conv_id").isNull().alias("unnamed"), "conv_id", "conv")).alias("first"), F.count("*").alias("copies"))
    maximal = classes.join(proper, key, "left_anti").select(*key, F.lit(True).alias("maximal"))
    classes = classes.join(maximal, key, "left")
    return last.join(classes, key).select(
        "conv", "conv_id", "n_rows", "copies", F.col("maximal").isNull().alias("is_prefix"),
        (F.col("maximal").isNotNull() & (F.col("conv") == F.col("first.conv"))).alias("kept"),
    )


def render(rows: DataFrame) -> DataFrame:
    """Of `turns`, each row's segment of the conversation's text and where it starts: conv_id, turn, part, start, segment."""
    neutral = F.replace(F.col("text"), F.lit("<|"), F.lit("< |"))
    named = F.replace(F.col("role"), F.lit("<|"), F.lit("< |"))
    segment = F.concat(F.lit(START), named, F.lit("\n"), neutral, F.lit(f"{END}\n"))
    made = rows.withColumn("segment", F.repeat(segment, F.col("n").cast("int"))).withColumn("size", F.char_length("segment").cast("bigint"))
    steps = stage(made.groupBy("conv", "position").agg(F.sum("size").alias("size")), "sizes")
    ends = _scan(steps, {"end": ("size", False)}).select("conv", "position", (F.col("end") - F.col("size")).alias("before"))
    among = Window.partitionBy("conv", "position").orderBy("role", "text")  # rows that share a turn
    own = F.coalesce(F.sum("size").over(among.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return made.withColumn("part", F.row_number().over(among)).withColumn("own", own).join(ends, ["conv", "position"]).select(
        "conv_id", "turn", "part", (F.col("before") + F.col("own")).alias("start"), "segment"
    )


def format_chats(conversations: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Segments of all maximal conversations, each conversation once: conv_id, turn, part, start, segment."""
    rows = stage(turns(conversations, columns), "turns")
    kept = maximal_conversations(rows).where("kept").select("conv")
    return render(stage(rows.join(kept, "conv", "left_semi"), "kept"))
