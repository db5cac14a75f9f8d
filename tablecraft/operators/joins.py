"""Join operators: strategy selection, size-checked broadcast, salting, temporal joins.

Spark already chooses broadcast, sort-merge or shuffled-hash joins, and adaptive query
execution re-plans at runtime (small side -> broadcast, skewed partition -> split).
These helpers only add what Spark does not decide by itself:

* ``bounded_broadcast`` hints a broadcast only when the optimizer's size estimate of the
  side is within a byte limit; past it the side is joined by shuffle, and AQE may still
  broadcast it once its shuffle size is known.
* ``salted_join`` spreads hot keys of the big side over ``salts`` sub-keys with a
  deterministic hash (a task retry sees the same salt, unlike ``rand``) and
  replicates only the matching rows of the small side.
* ``temporal_join`` matches facts to the version valid at their time: an as-of sweep
  (sort facts and versions together per key) for non-overlapping versions, or an
  equi-join with the interval as a residual condition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.functions.columns import hash_bucket
from tablecraft.operators.aggregates import heavy_keys

DEFAULT_BROADCAST_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it from file sizes; runs no job. The
    estimate of a filter or projection is not below its output, that of a join may be
    far above it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` is estimated at ``max_bytes`` or less, else ``df`` unchanged."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    strategy: str = "auto",
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Join with an optional strategy request.

    ``auto`` leaves the choice to Catalyst and AQE; ``broadcast`` broadcasts ``right``
    only within ``max_broadcast_bytes``; ``merge`` and ``shuffle_hash`` are join hints.
    """
    if strategy == "broadcast":
        right = bounded_broadcast(right, max_broadcast_bytes)
    elif strategy in ("merge", "shuffle_hash", "shuffle_replicate_nl"):
        right = right.hint(strategy)
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy!r}")
    return left.join(right, on, how)


def hot_keys(df: DataFrame, keys: Sequence[str], min_share: float = 0.05) -> list[tuple]:
    """Keys holding at least ``min_share`` of all rows, as a list of key tuples.

    There are at most ``1/min_share`` of them (20 by default), so the list is a proven
    small bound and comes to the driver once. They are found by a sketch, and only the rows
    of its candidates are grouped and counted exactly (:func:`heavy_keys`).
    """
    found = heavy_keys(df, keys, min_share).filter(F.col("n") >= 2)
    return [tuple(r) for r in found.select(*keys).collect()]


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    salts: int | None = None,
    how: str = "inner",
    hot: Sequence[tuple] | None = None,
) -> DataFrame:
    """Equi-join on ``keys`` with hot keys of ``big`` split ``salts`` ways (by default over
    as many sub-keys as there are shuffle partitions, so that a key's share of a task
    falls as the cluster grows).

    ``hot`` lists the key tuples to split (see :func:`hot_keys`, whose size is bounded
    by construction); they are matched with an ``isin`` expression, no extra join.
    Without it every key is salted and ``small`` is replicated ``salts`` times.
    Supported ``how``: inner, left (outer side = ``big``). Rows with a null key match
    nothing and are spread like a hot key.
    """
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salted_join keeps big as the preserved side: inner or left")
    big_s, small_s = salted_sides(big, small, keys, salts, hot)
    return big_s.join(small_s, [*keys, "_salt"], how).drop("_salt")


def salted_sides(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    salts: int | None = None,
    hot: Sequence[tuple] | None = None,
    name: str = "_salt",
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a :func:`salted_join` with the sub-key ``name``, to be joined on the keys
    and it: spread over ``salts`` values in the hot rows of ``big``, replicated in ``small``.
    Written bucketed by keys and sub-key, no file holds a whole hot key."""
    keys = list(keys)
    salts = salts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt_of_row = hash_bucket(salts, *big.columns)
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is None:
        return big.withColumn(name, salt_of_row), small.withColumn(name, F.explode(all_salts))

    def is_hot(df: DataFrame):
        if not hot:
            return F.lit(False)
        if len(keys) == 1:
            return F.coalesce(F.col(keys[0]).isin([k[0] for k in hot]), F.lit(False))
        cond = F.lit(False)
        for k in hot:
            match = F.lit(True)
            for key, value in zip(keys, k):
                match = match & F.col(key).eqNullSafe(F.lit(value))
            cond = cond | match
        return cond

    spread = is_hot(big)
    for k in keys:
        spread = spread | F.col(k).isNull()
    small_salts = F.when(is_hot(small), all_salts).otherwise(F.array(F.lit(0)))
    return (big.withColumn(name, F.when(spread, salt_of_row).otherwise(F.lit(0))),
            small.withColumn(name, F.explode(small_salts)))


def without_overlap(dim: DataFrame, keys: Sequence[str], from_col: str = "effective_from", to_col: str = "effective_to") -> DataFrame:
    """``dim``, raising when it is computed if two versions of a key overlap: if one begins
    before the one that began before it has ended (an open end never does). The versions of a
    key are compared with their neighbours in order of ``from_col``, hot keys in ranges."""
    from tablecraft.operators.windows import bounded_window_ranged

    def following(w):
        return {"_next": F.lead(from_col).over(w), "_last": F.lead(F.lit(False), 1, True).over(w)}

    out = bounded_window_ranged(dim, keys, [from_col], following, 0, 1)
    overlap = ~F.col("_last") & (F.col(to_col).isNull() | F.col("_next").isNull() | (F.col("_next") <= F.col(to_col)))
    for k in keys:  # rows without a key match nothing
        overlap = overlap & F.col(k).isNotNull()
    wrong = F.raise_error(F.lit(f"versions overlap on {', '.join(keys)}")).cast("boolean")
    return out.filter(F.when(overlap, wrong).otherwise(F.lit(True))).drop("_next", "_last")


def temporal_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    event_col: str,
    from_col: str = "effective_from",
    to_col: str = "effective_to",
    how: str = "left",
    method: str = "join",
) -> DataFrame:
    """Join each fact row to the dimension version valid at ``event_col``.

    Valid means ``from <= t`` and (``to`` is null or ``t <= to``), both ends
    inclusive. The dimension's key columns are dropped from the output.

    The caller names the method; nothing about the data changes it. ``method="join"``
    (default) is the equi-join with the interval as a residual condition: overlapping
    versions are allowed, and a fact matches every valid version. ``method="sweep"``
    is an as-of merge (SCD-2) for versions that do not overlap per key, which is checked
    (:func:`without_overlap`): facts and versions are sorted together per key and each
    fact takes the latest version started at or before it, if that has not ended. No fact x
    version comparisons, and a hot key is split across tasks (ranges with a carried "last
    version").
    """
    keys = list(keys)
    if method == "join":
        return _temporal_equi_join(fact, dim, keys, event_col, from_col, to_col, how)
    if method != "sweep":
        raise ValueError(f"unknown method {method!r}")
    from tablecraft.operators.windows import _split, _with_segments

    dim_cols = [c for c in dim.columns if c not in keys]
    fact_cols = [c for c in fact.columns if c not in keys]
    ver = F.struct(*[F.col(c) for c in dim_cols])
    rec = F.struct(*[F.col(c) for c in fact_cols])
    ver_type = dim.select(ver.alias("v")).schema["v"].dataType
    rec_type = fact.select(rec.alias("r")).schema["r"].dataType
    t_type = fact.schema[event_col].dataType
    versions = without_overlap(dim, keys, from_col, to_col).select(
        *keys, F.col(from_col).cast(t_type).alias("_t"), F.lit(0).alias("_kind"),
        ver.alias("_ver"), F.lit(None).cast(rec_type).alias("_rec"),
    )
    facts = fact.select(
        *keys, F.col(event_col).alias("_t"), F.lit(1).alias("_kind"),
        F.lit(None).cast(ver_type).alias("_ver"), rec.alias("_rec"),
    )
    order = ["_t", "_kind"]  # a version starting at t applies to facts at t
    w = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split, cut = _split(versions.unionByName(facts), keys, order, None)
    local = split.withColumn("_last", F.last("_ver", ignorenulls=True).over(w)).filter(F.col("_kind") == 1)
    if cut:
        # per (range, key): the segment's latest version, carried into the key's later ranges
        seg = split.filter("_range > 0").groupBy("_range", *keys).agg(
            F.max(F.when(F.col("_kind") == 0, F.struct("_t", "_ver"))).alias("_seg_last"))
        before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        carry = seg.select("_range", *keys, F.last("_seg_last", ignorenulls=True).over(before).getField("_ver").alias("_carry"))
        local = _with_segments(local, F.broadcast(carry.filter(F.col("_carry").isNotNull())), ["_range", *keys])
    else:
        local = local.withColumn("_carry", F.lit(None).cast(ver_type))
    v = F.coalesce(F.col("_last"), F.col("_carry"))
    valid = v.isNotNull() & (v.getField(to_col).isNull() | (F.col("_t") <= v.getField(to_col)))
    matched = (
        local
        # a null key matches no version, as in a join
        .withColumn("_v", F.when(valid & ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)), v))
    )
    if how == "inner":
        matched = matched.filter(F.col("_v").isNotNull())
    elif how not in ("left", "left_outer"):
        raise ValueError("temporal_join supports inner and left")
    return matched.select(
        *keys, *[F.col(f"_rec.{c}").alias(c) for c in fact_cols], *[F.col(f"_v.{c}").alias(c) for c in dim_cols]
    )


def _temporal_equi_join(fact, dim, keys, event_col, from_col, to_col, how):
    renamed = dim
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_dim_{k}")
    t = fact[event_col]
    cond = [fact[k] == renamed[f"_dim_{k}"] for k in keys]
    cond.append(t >= renamed[from_col])
    cond.append(renamed[to_col].isNull() | (t <= renamed[to_col]))
    out = fact.join(renamed, cond, how)
    return out.drop(*[f"_dim_{k}" for k in keys])


def orphans(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` has no match in ``dim`` (left anti join).

    A null key never matches, so rows with a null key are reported too.
    """
    dim_key = dim_key or key
    d = dim.select(F.col(dim_key).alias("_ref"))
    return df.join(d, F.col(key) == F.col("_ref"), "left_anti")
