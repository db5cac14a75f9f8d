"""Connected components of an edge list, as DataFrame rounds.

Each round hooks every vertex to its smallest neighbour, shortens the pointers until
they reach a root, and contracts the edges to the roots. The number of vertices that
still have edges falls quickly, every round is a few shuffles over the remaining edges,
and nothing but row counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.frames import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has columns a, b of one orderable type. Returns (node, root) with the
    smallest reachable vertex as root, for every vertex that is not its own root."""
    e = stored(_undirected(edges), "edges")
    rounds: list[DataFrame] = []
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).where("b < a")
        hooks = _shortened(stored(hooks.select(F.col("a").alias("node"), F.col("b").alias("root")), "hooks"))
        rounds.append(hooks)
        e = stored(_undirected(_moved(_moved(e, "a", hooks), "b", hooks)), "edges")
    if not rounds:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds.pop()
    while rounds:
        # vertices hooked in an earlier round left the graph, so the two sets are disjoint
        out = _moved(rounds.pop(), "root", out).unionByName(out)
    return stored(out, "roots")


def _undirected(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _moved(df: DataFrame, column: str, to_root: DataFrame) -> DataFrame:
    """Replace ``column`` by its root where it has one."""
    m = to_root.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return df.join(m, F.col(column) == F.col("_node"), "left").withColumn(
        column, F.coalesce("_root", column)).drop("_node", "_root")


def _shortened(hooks: DataFrame) -> DataFrame:
    """Point every vertex at the root of its tree (pointers always go to smaller vertices)."""
    while True:
        m = hooks.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        step = hooks.join(m, F.col("root") == F.col("_node"), "left")
        step = stored(step.select("node", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("_moved")), "hooks")
        hooks = step.drop("_moved")
        if step.where("_moved").isEmpty():
            return hooks
