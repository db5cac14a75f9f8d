"""Chat formatting of logged conversations, in DataFrame expressions only.

A log often holds a conversation several times, as snapshots that grow by some turns.
Turns get their place in the conversation, a hash of place, role and text, and the rolling
combination (exclusive or, 128 bits) of all hashes up to them, which names the prefix that
ends there. A conversation whose whole equals a proper prefix of a longer one is a
snapshot; anti-joining the wholes with the prefixes leaves the maximal conversations, and
equal ones keep the smallest id. Both sides are made distinct before they meet, so a first
turn or a conversation shared by a third of the log is one row there.

Turns are numbered and combined in blocks of ``_BLOCK`` turn numbers, and blocks in
conversations, so a conversation of any length is spread over tasks (turns with equal or no
number share a block). The result has a row per turn, in a form that concatenates to the
training text in order of ``position``; a conversation is never gathered in one row unless
``assembled`` asks for it.

Edge cases. Turns are ordered by turn, role and text, nulls first; repeated rows are turns
of their own. Turns without a conversation id form one conversation. A null role renders
as ``unknown``, a null text as nothing; for comparison nulls differ from empty strings.
Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.llm.frames import stored

_BLOCK = 1024
_CONV = ["_c1", "_c2"]


def _numbered(turns: DataFrame) -> DataFrame:
    """Turns with their position, the rolling hash (x1, x2) and the number of turns (n)."""
    block = [*_CONV, "_b"]
    within = Window.partitionBy(*block).orderBy("turn", "role", "text")
    turns = turns.withColumn("_b", F.floor(F.col("turn") / _BLOCK)).withColumn("_b", F.coalesce("_b", F.lit(-(1 << 62))))
    # blocks of a conversation are few: one per _BLOCK turn numbers
    blocks = turns.groupBy(*block).agg(F.count(F.lit(1)).alias("size"))
    ahead = Window.partitionBy(*_CONV).orderBy("_b")
    blocks = blocks.select(*block, F.coalesce(F.sum("size").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("skip"),
                           F.sum("size").over(Window.partitionBy(*_CONV)).alias("n"))
    turns = turns.withColumn("_r", F.row_number().over(within)).join(blocks, block)
    turns = turns.withColumn("position", F.col("_r") + F.col("skip"))
    for x, seed in (("x1", 21), ("x2", 22)):
        shape = F.struct(F.col("role").isNull(), F.col("text").isNull())
        turns = turns.withColumn(x, F.xxhash64(F.lit(seed), "position", "role", "text", shape))
    rolling = Window.partitionBy(*block).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    sums = turns.groupBy(*block).agg(F.expr("bit_xor(x1)").alias("s1"), F.expr("bit_xor(x2)").alias("s2"))
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*block, *[F.coalesce(F.expr(f"bit_xor(s{i})").over(before), F.lit(0)).alias(f"a{i}") for i in (1, 2)])
    turns = turns.withColumns({f"x{i}": F.expr(f"bit_xor(x{i})").over(rolling) for i in (1, 2)}).join(sums, block)
    return turns.withColumns({f"x{i}": F.col(f"x{i}").bitwiseXOR(F.col(f"a{i}")) for i in (1, 2)}).drop("_b", "_r", "skip", "a1", "a2")


def segment(role: Column, text: Column) -> Column:
    """One turn of the training text."""
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("unknown")), F.lit("\n"),
                    F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def maximal_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                          role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, position, n_turns, role, segment) for every turn of the conversations that are
    no snapshot of a longer one."""
    turns = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"),
        F.xxhash64(F.lit(1), conv_col).alias("_c1"), F.xxhash64(F.lit(2), conv_col).alias("_c2"))
    turns = stored(_numbered(turns), "turns")
    marks = turns.select("conv", *_CONV, "position", "n", "x1", "x2")
    whole = marks.where("position = n").groupBy("n", "x1", "x2").agg(F.min(F.struct("conv", *_CONV)).alias("c"))
    prefixes = marks.where("position < n").select(F.col("position").alias("n"), "x1", "x2").distinct()
    kept = whole.join(prefixes, ["n", "x1", "x2"], "left_anti").select("c._c1", "c._c2")
    return turns.join(kept, _CONV, "left_semi").select(
        "conv", "position", F.col("n").alias("n_turns"), "role", segment(F.col("role"), F.col("text")).alias("segment"))


def assembled(segments: DataFrame) -> DataFrame:
    """(conv, text): whole conversations, for logs whose conversations fit a row."""
    parts = F.array_sort(F.collect_list(F.struct("position", "segment")))
    return segments.groupBy("conv").agg(F.array_join(F.transform(parts, lambda p: p["segment"]), "").alias("text"))
