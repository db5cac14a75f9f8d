"""Prefix trie of conversations, and subtree totals by parallel tree contraction.

Every distinct sequence of a conversation's first turns is a node. Its name is the rolling
hash of the turns (128 bits, place by place), so the nodes are a grouping of all
conversations' turns. A node is then known by its smallest member and its depth: the nodes
that share a smallest member lie under each other, which gives the tree's long chains a name.

Totals over subtrees come from contraction, in rounds of joins on node keys:

* Rake: every leaf is done; its total is what it holds. Sums of leaves go to their parents
  (combined before the shuffle, so a node with a million children costs a row a task).
* Compress: runs of nodes with one child each, cut into stretches of depth that grow by
  ``_STRETCH`` from round to round, become their topmost node, which takes over what they
  hold. A node of the run keeps the share that it has less than the topmost.

The number of rounds is logarithmic in the number of nodes, for chains as for bushy trees.
Afterwards the rounds are undone from the last to the first: a compressed node's total is that
of its topmost node less its share. Every round is written to the shared scratch folder, and
only row counts reach the driver. All joins are on unique node keys, so nothing is skewed.

Conversations of any length are spread over tasks: turns get their numbers from a range split
(equal turn numbers of a conversation, and nothing else, share a task), and rolling hashes are
combined in stretches of ``_STRETCH`` turns. The list of conversations that end in a node may
be as long as the table; it is digested as a sorted stream of chunks, never held at once.

Edge cases. Turns are ordered by turn, role and text, nulls first; repeated rows are turns of
their own. Null roles and texts are empty. Turns without a conversation id belong to no
conversation and are left out. A base that is absent lends nothing; a conversation that is left
without turns ends in the root. Empty table: no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.llm.frames import default_parallelism, small_batches, stored
from tablecraft.operators.windows import rankings_ranged

_STRETCH = 1024
_NODE = ["label", "depth"]


def turns_in_order(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, at, role, text): turns numbered from 1 within their conversation."""
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    turns = rankings_ranged(turns, ["conv"], ["turn", "role", "text"], {"at": "row_number"})
    return stored(turns.drop("turn"), "turns")


def rebuilt(turns: DataFrame, base: Column, shared: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that take their first ``shared`` turns from the conversation ``base``
    (both columns of ``conv``) and the turns after these many from themselves. ``shared``
    must be small. Returns their turns, and (conv, n) with the number."""
    sizes = turns.groupBy("conv").agg(F.max("at").alias("n"))
    convs = sizes.select("conv", "n", base.alias("base"), shared.cast("long").alias("h"))
    of_base = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(of_base, "base", "left").select(
        "conv", "base", "h", F.when(F.col("n_base").isNull(), 0).otherwise(F.least("h", "n_base")).alias("taken"),
        (F.col("n") - F.least("n", "h")).alias("own"))
    convs = stored(convs, "rebuilt")
    c = convs.withColumnRenamed("conv", "_conv")
    own = turns.join(c, (F.col("conv") == F.col("_conv"))).where("at > h").select(
        "conv", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "role", "text")
    most = convs.agg(F.max("taken")).first()[0] or 0
    lent = turns.where(F.col("at") <= most).withColumnRenamed("conv", "base").join(convs, "base").where("at <= taken")
    return own.unionByName(lent.select("conv", "at", "role", "text")), convs.select("conv", (F.col("taken") + F.col("own")).alias("n"))


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv, at, bytes, x1, x2, p1, p2): names of the prefix that ends at every turn and
    of the one before it."""
    stretch = ["conv", "_s"]
    turns = turns.select("conv", "at", F.floor((F.col("at") - 1) / _STRETCH).alias("_s"), F.octet_length("text").cast("long").alias("bytes"),
                         *[F.xxhash64(F.lit(k), "at", "role", F.lit("|"), "text").alias(f"h{k}") for k in (1, 2)])
    within = Window.partitionBy(*stretch).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("conv").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    turns = stored(turns.withColumns({f"x{k}": F.expr(f"bit_xor(h{k})").over(within) for k in (1, 2)}), "prefixes")
    whole = turns.groupBy(*stretch).agg(*[F.expr(f"bit_xor(h{k})").alias(f"h{k}") for k in (1, 2)])
    before = whole.select(F.col("conv").alias("_conv"), F.col("_s").alias("_t"),
                          *[F.coalesce(F.expr(f"bit_xor(h{k})").over(ahead), F.lit(0)).alias(f"a{k}") for k in (1, 2)])
    out = turns.join(before, (F.col("conv") == F.col("_conv")) & (F.col("_s") == F.col("_t")))
    x = {f"x{k}": F.col(f"x{k}").bitwiseXOR(F.col(f"a{k}")) for k in (1, 2)}
    return out.withColumns(x).select(
        "conv", "at", "bytes", "x1", "x2", *[F.col(f"x{k}").bitwiseXOR(F.col(f"h{k}")).alias(f"p{k}") for k in (1, 2)])


def trie(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes (label, depth, above, n_convs, bytes), where ``label`` is the smallest
    member and ``above`` the parent's; and (label, depth, conv) for every conversation's
    last node."""
    prefixes = stored(_prefixes(turns), "prefixes")
    name = ["depth", "x1", "x2"]
    found = prefixes.select(F.col("at").alias("depth"), "x1", "x2", "p1", "p2", "conv", "bytes")
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "x1", "x2", "p1", "p2")]
    found = found.unionByName(sizes.select(*zero, "conv", F.lit(0).cast("long").alias("bytes")))
    nodes = stored(found.groupBy(*name).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("label"), F.first("p1").alias("p1"),
        F.first("p2").alias("p2"), F.first("bytes").alias("bytes")), "nodes")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("label").alias("above"))
    tree = nodes.join(up, ["depth", "p1", "p2"], "left").select("label", "depth", "above", "n_convs", "bytes")
    last = prefixes.join(sizes.select(F.col("conv").alias("_conv"), "n"), (F.col("conv") == F.col("_conv")) & (F.col("at") == F.col("n")))
    last = last.select("conv", F.col("at").alias("depth"), "x1", "x2").unionByName(
        sizes.where("n = 0").select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("x1"), F.lit(0).cast("long").alias("x2")))
    ends = last.join(nodes.select(*name, "label"), name).select("label", "depth", "conv")
    return stored(tree, "tree"), stored(ends, "ends")


def _round(alive: DataFrame, values: list[str], depths: int) -> tuple[DataFrame, DataFrame]:
    """One rake and compress. ``alive`` has label, depth, up_label, up_depth, kids and the
    values. Returns the nodes that go on, and the compressed ones with ``top`` (the depth of
    the node of the same label that stands for them) and the share that they lack of it."""
    leaf, up = F.col("kids") == 0, ["up_label", "up_depth"]
    below = alive.where("up_label is not null").groupBy(*up).agg(
        *[F.sum(F.when(leaf, F.col(v))).alias(f"_{v}") for v in values],
        F.count_if(~leaf).alias("_kids"), F.min(F.when(~leaf, F.struct(*_NODE))).alias("_kid"))
    below = below.select(F.col("up_label").alias("label"), F.col("up_depth").alias("depth"), *[f"_{v}" for v in values], "_kids", "_kid")
    inner = alive.where(~leaf).join(below, _NODE)
    inner = inner.withColumns({v: F.col(v) + F.coalesce(f"_{v}", F.lit(0)) for v in values} | {"kids": F.col("_kids")}).drop("_kids", *[f"_{v}" for v in values])

    # nodes of a label lie under each other: neighbours in depth are parent and child
    one = F.col("kids") == 1
    by_depth = Window.partitionBy("label", "_s").orderBy("depth")
    runs = inner.withColumn("_s", F.floor(F.col("depth") / depths)).withColumn(
        "_cut", F.when(one & F.coalesce(F.lag(one).over(by_depth), F.lit(False)), 0).otherwise(1))
    runs = runs.withColumn("_run", F.sum("_cut").over(by_depth.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("label", "_s", "_run")
    earlier = run.orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns(
        {"top": F.min("depth").over(run), "_last": F.max("depth").over(run)}
        | {f"_less_{v}": F.coalesce(F.sum(v).over(earlier), F.lit(0)) for v in values}
        | {f"_all_{v}": F.sum(v).over(run) for v in values})
    runs = stored(runs, "runs")

    compressed = runs.where("depth > top").select(*_NODE, "top", *[F.col(f"_less_{v}").alias(v) for v in values])
    tops = runs.where("depth = top").select(*_NODE, *up, "kids", *[F.col(f"_all_{v}").alias(v) for v in values])
    moved = runs.where("depth = _last and _last > top").select(
        F.col("_kid.label").alias("label"), F.col("_kid.depth").alias("depth"), F.col("label").alias("_l"), F.col("top").alias("_d"))
    go_on = tops.join(moved, _NODE, "left").withColumns(
        {"up_label": F.coalesce("_l", "up_label"), "up_depth": F.coalesce("_d", "up_depth")}).drop("_l", "_d")
    return stored(go_on, "alive"), compressed


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(label, depth, kids, values): sums of the values over every node's subtree. ``tree``
    has label, depth, above (the parent's label) and the values; kids counts children."""
    up = tree.select("label", "depth", F.col("above").alias("up_label"), (F.col("depth") - 1).alias("up_depth"), *values)
    kids = tree.where("above is not null").groupBy(F.col("above").alias("label"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("kids"))
    alive = first = stored(up.join(kids, _NODE, "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "alive")
    raked, compressed, depths = [], [], _STRETCH
    while not alive.isEmpty():
        raked.append(alive.where("kids = 0").select(*_NODE, *values))
        alive, gone = _round(alive, values, depths)
        compressed.append(gone)
        depths = min(depths * _STRETCH, 1 << 60)
    total = None
    for done, gone in zip(reversed(raked), reversed(compressed)):
        # tops of this round were raked or compressed in later ones
        if total is not None:
            t = total.select("label", F.col("depth").alias("top"), *[F.col(v).alias(f"_{v}") for v in values])
            back = gone.join(t, ["label", "top"]).select(*_NODE, *[(F.col(f"_{v}") - F.col(v)).alias(v) for v in values])
            done = total.unionByName(back).unionByName(done)
        total = stored(done, "totals")
    kids = first.select(*_NODE, "kids")
    return kids.join(total, _NODE) if total is not None else first.select(*_NODE, "kids", *values)


def ends_digest(ends: DataFrame) -> DataFrame:
    """(label, depth, ends_sha256): digest of the ids that end in a node, ascending, as
    decimals joined by commas. Sorted ranges are cut to chunks of text, and the chunks of a
    node streamed through one digest."""
    n = default_parallelism(ends.sparkSession)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, depth, conv = (b.column(i).to_pylist() for i in range(3))
            new = [i for i in range(len(conv)) if not i or depth[i] != depth[i - 1] or label[i] != label[i - 1]]
            parts = [",".join(map(str, conv[a:z])) for a, z in zip(new, new[1:] + [len(conv)])]
            first = b.take(pa.array(new, pa.int64()))
            yield pa.RecordBatch.from_arrays([*first.columns, pa.array(parts, pa.string())], ["label", "depth", "first", "part"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, kinds = None, None, None

        def rows(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], ["label", "depth", "ends_sha256"])

        for b in batches:
            kinds, out = [b.column(0).type, b.column(1).type, pa.string()], []
            for label, depth, part in zip(*(b.column(i).to_pylist() for i in (0, 1, 3))):
                if node == (label, depth):
                    state.update(b"," + part.encode())
                    continue
                if state is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (label, depth), hashlib.sha256(part.encode())
            yield rows(out)
        if state is not None:
            yield rows([(*node, state.hexdigest())])

    small_batches(ends.sparkSession)
    kind = ends.schema["label"].dataType.simpleString()
    ordered = ends.select(*_NODE, "conv").repartitionByRange(n, *_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
    parts = ordered.mapInArrow(chunks, f"label {kind}, depth long, first {kind}, part string")
    return parts.repartition(n, *_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(
        digest, f"label {kind}, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The trie of conversations given by their turns (conv, at, role, text) and numbers of
    turns (conv, n): a row per node with conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, and over the subtree n_leaves and saved_bytes (bytes of each node's
    last text, once less than it has members); ends_sha256 of the ids that end here."""
    tree, ends = trie(turns, sizes)
    parents = tree.where("above is not null").select(F.col("above").alias("label"), (F.col("depth") - 1).alias("depth")).distinct()
    valued = tree.join(parents.withColumn("_parent", F.lit(True)), _NODE, "left").withColumns({
        "leaves": F.when(F.col("_parent").isNull(), 1).otherwise(0).cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("bytes")})
    totals = subtree_totals(valued.select("label", "depth", "above", "leaves", "saved"), ["leaves", "saved"])
    out = tree.join(totals, _NODE).join(ends_digest(ends), _NODE, "left")
    return out.select(
        F.col("label").alias("conv_id"), "depth", F.col("above").alias("parent_conv_id"), "n_convs", F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_bytes"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
