"""Window operators: rankings, running totals, moving averages, lag deltas.

Every ordered window takes explicit tie-breakers: ordering by a date alone leaves
ties in an undefined order and makes running values non-deterministic.

A plain window processes each partition key in one task. Every operator here also has
a range-split form (``ranged=True``) that cuts a large or hot key across tasks; see
the section "range-split windows" below. The caller chooses the form; both give the
same result, null keys included.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.functions.columns import money, round2
from tablecraft.operators.aggregates import heavy_hashes

OrderSpec = Sequence[str | Column]


def _spec(partition_cols: Sequence[str], order_cols: OrderSpec):
    w = Window.partitionBy(*partition_cols) if partition_cols else Window.partitionBy()
    return w.orderBy(*order_cols)


def rank_within(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    kind: str = "rank",
    name: str | None = None,
    ranged: bool = False,
    stage: bool = False,
) -> DataFrame:
    """Add ``rank`` / ``dense_rank`` / ``row_number`` (as bigint) within partitions.

    ``ranged=True`` splits large partitions over tasks (:func:`rank_within_ranged`).
    """
    if ranged:
        return rank_within_ranged(df, partition_cols, order_cols, kind, name, stage=stage)
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[kind]
    return df.withColumn(name or kind, fn().over(_spec(partition_cols, order_cols)).cast("long"))


def top_n_per_group(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    n: int = 1,
    kind: str = "rank",
    name: str = "rank_in_group",
) -> DataFrame:
    """Rows ranked ``<= n`` in their group.

    Spark plans the rank filter as a window group limit: each task keeps only its
    local top ``n`` per group before the shuffle.
    """
    ranked = rank_within(df, partition_cols, order_cols, kind, name)
    return ranked.filter(F.col(name) <= n)


def running_total(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    value_col: str,
    name: str = "running_total",
    ranged: bool = False,
    stage: bool = False,
) -> DataFrame:
    """Exact cumulative sum, frame ``ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW``.

    ``ranged=True`` splits hot keys over tasks (:func:`running_total_ranged`).
    """
    if ranged:
        return running_total_ranged(df, partition_cols, order_cols, value_col, name, stage=stage)
    w = _spec(partition_cols, order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(money(value_col)).over(w).cast("double"))


def moving_average(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    value_col: str,
    preceding: int = 3,
    following: int = 3,
    name: str = "moving_avg",
    rounded: bool = True,
    ranged: bool = False,
    stage: bool = False,
) -> DataFrame:
    """Centred moving average over ``ROWS BETWEEN -preceding AND +following``."""

    def build(w):
        f = w.rowsBetween(-preceding, following)
        avg = F.sum(money(value_col)).over(f).cast("double") / F.count(F.col(value_col)).over(f)
        return {name: round2(avg) if rounded else avg}

    if ranged:
        return bounded_window_ranged(df, partition_cols, order_cols, build, preceding, following, stage=stage)
    return df.withColumns(build(_spec(partition_cols, order_cols)))


def lag_delta(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    value_col: str,
    prev_name: str = "prev_value",
    delta_name: str = "delta",
    ranged: bool = False,
    stage: bool = False,
) -> DataFrame:
    """Previous value in the partition (null at the first row) and the difference."""
    out = _with_lag(df, partition_cols, order_cols, value_col, prev_name, ranged, stage)
    return out.withColumn(delta_name, F.col(value_col) - F.col(prev_name))


def _with_lag(df, partition_cols, order_cols, value_col, prev_name, ranged, stage):
    def build(w):
        return {prev_name: F.lag(F.col(value_col), 1).over(w)}

    if ranged:
        return bounded_window_ranged(df, partition_cols, order_cols, build, 1, 0, stage=stage)
    return df.withColumns(build(_spec(partition_cols, order_cols)))


def lag_pct_change(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    value_col: str,
    prev_name: str = "prev_value",
    pct_name: str = "pct_change",
    ranged: bool = False,
    stage: bool = False,
) -> DataFrame:
    """Percent change to the previous value, rounded to 2; null when previous is 0/null."""
    out = _with_lag(df, partition_cols, order_cols, value_col, prev_name, ranged, stage)
    out = out.withColumn(prev_name, F.coalesce(F.col(prev_name), F.lit(0.0)))
    p = F.col(prev_name)
    pct = (F.col(value_col) - p) / p * F.lit(100.0)
    return out.withColumn(pct_name, F.when(p == 0, F.lit(None)).otherwise(round2(pct)))


# ---------------------------------------------------------------- range-split windows
# A window partitioned by a key runs each key in one task. When one key holds a large
# share of the rows (a hot customer, or a low-cardinality key such as a tier), the
# range-split forms below cut its ordered rows into ranges handled by different tasks:
#
# 1. A heavy-hitter sketch over the keys finds those that hold more than a task's share of
#    the rows (one pass, one row per task shuffled). Other keys are windowed as always.
# 2. Quantiles of the first order column over the hot rows are the bounds of the ranges.
#    A row's range number is an expression of its key and order value (a binary
#    search in the bounds), so equal order values share a range.
# 3. The window runs per (range, key): one exchange, nothing written.
# 4. A key's earlier ranges are added from a table of its segments, of which there are at
#    most twice as many as ranges and hot keys; keys are matched null-safely, as windows
#    group nulls.
#
# The input is computed again for each of these steps; one that is dearer than a scan can be
# written first (``stage=True``).

#: Keys below this share are not looked for: the sketch's size goes by its inverse.
_LEAST_SHARE = 1e-4
#: Most ranges, and most bounds that a row is compared with.
_MOST_RANGES = 10_000


def _first_order(df: DataFrame, order: OrderSpec) -> tuple[str, bool, bool]:
    """(column, descending, nulls first) of the first order column."""
    c = order[0]
    if isinstance(c, str):
        return c, False, True
    m = re.fullmatch(r"Column<'`?(.*?)`?(?: (ASC|DESC) NULLS (FIRST|LAST))?'>", str(c))
    if m is None or m[1] not in df.columns:
        raise ValueError("a range split orders by named columns: add the expression as a column first")
    return m[1], m[2] == "DESC", m[3] != "LAST"


def _as_number(df: DataFrame, order: OrderSpec) -> tuple[Column, bool]:
    """A double that never falls where the first order column rises (strings by their first
    six bytes), and whether the order is falling. NaN is the largest, as in Spark's order."""
    name, descending, nulls_first = _first_order(df, order)
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        x = c.cast("double")
        x = F.when(F.isnan(x), float("inf")).otherwise(x)
    elif isinstance(kind, T.DateType):
        x = F.unix_date(c).cast("double")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        x = F.unix_micros(c.cast("timestamp")).cast("double")
    elif isinstance(kind, T.BooleanType):
        x = c.cast("int").cast("double")
    elif isinstance(kind, T.StringType):
        x = F.conv(F.rpad(F.hex(F.substring(F.encode(c, "utf-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    else:  # no split by this type
        x = F.lit(0.0)
    return F.coalesce(x, F.lit(float("-inf" if nulls_first != descending else "inf"))), descending


def _split(df: DataFrame, keys: Sequence[str], order: OrderSpec, n: int | None) -> tuple[DataFrame, bool]:
    """``df`` with the range number ``_range`` of every row (0: its key is not split), and
    whether any key is."""
    spark = df.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = df.withColumn("_range", F.lit(0))
    total, heavy = heavy_hashes(df, keys, max(1.0 / n, _LEAST_SHARE))
    if n == 1 or not heavy:
        return whole, False
    hot = spark.createDataFrame([(h, min(_MOST_RANGES, math.ceil(c * n / total) + 1)) for h, c in heavy], "_hot long, _parts int")
    if keys:
        marked = df.join(F.broadcast(hot), F.xxhash64(*keys) == F.col("_hot"), "left").drop("_hot")
    else:
        marked = df.withColumn("_parts", F.lit(min(_MOST_RANGES, n + 1)))
    x, descending = _as_number(df, order)
    marked = marked.withColumn("_x", F.when(F.col("_parts").isNotNull(), x))
    ranges = min(_MOST_RANGES, math.ceil(sum(c for _, c in heavy) * n / total) + 1)
    at = [i / ranges for i in range(1, ranges)]
    found = marked.filter("_x is not null").agg(F.percentile_approx("_x", at, 10 * ranges)).first()[0] or []
    bounds = sorted({b for b in found if math.isfinite(b)})
    if not bounds:
        return whole, False
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="_x", outputCol="_r")
    r = F.lit(len(bounds)) - F.col("_r") if descending else F.col("_r")
    # a key gets as many ranges as it needs: neighbouring ones are put together
    r = F.floor(r * F.col("_parts") / (len(bounds) + 1)).cast("int") + 1
    marked = cut.transform(marked).withColumn("_range", F.coalesce(r, F.lit(0)))
    return marked.drop("_parts", "_x", "_r"), True


def _staged(df: DataFrame, stage: bool) -> DataFrame:
    return _checkpoint(df) if stage else df


def _checkpoint(df: DataFrame) -> DataFrame:
    from tablecraft.sources.scratch import cut_lineage

    return cut_lineage(df)


def _with_segments(local: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a per-segment table; null keys match null keys."""
    renamed = table.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in table.columns if c not in on])
    match = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    return local.join(renamed, match, how).drop(*[f"_on_{c}" for c in on])


def _before(segments: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Per (range, key): sums of the metrics over the key's earlier ranges; broadcast, as
    segments are bounded by the ranges and hot keys."""
    w = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = segments.select("_range", *keys, *[F.sum(m).over(w).alias(m) for m in metrics])
    return F.broadcast(sums.filter(F.col(metrics[0]).isNotNull()))


def cumulative(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    value: Column,
    name: str,
    num_partitions: int | None = None,
    stage: bool = False,
) -> DataFrame:
    """Running sum of the expression ``value`` (of an exact type) per key, hot keys split."""
    keys = list(partition_cols)
    split, cut = _split(_staged(df, stage), keys, order_cols, num_partitions)
    w = Window.partitionBy("_range", *keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = split.withColumn(name, F.sum(value).over(w))
    if cut:
        segments = split.filter("_range > 0").groupBy("_range", *keys).agg(F.sum(value).alias("_carry"))
        local = _with_segments(local, _before(segments, keys, ["_carry"]), ["_range", *keys])
        local = local.withColumn(name, F.when(F.col("_carry").isNull(), F.col(name)).otherwise(F.coalesce(name, F.lit(0)) + F.col("_carry")))
    return local.select(*df.columns, name)


def running_total_ranged(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    value_col: str,
    name: str = "running_total",
    num_partitions: int | None = None,
    stage: bool = False,
) -> DataFrame:
    """Exact cumulative sum per key, with a hot key split across tasks.

    Local running sums per (range, key) segment plus a carry: the key's total in its
    earlier ranges. ``order_cols`` should make the order total (end with a unique
    tie-breaker), as for :func:`running_total`.
    """
    out = cumulative(df, partition_cols, order_cols, money(value_col), name, num_partitions, stage)
    return out.withColumn(name, F.col(name).cast("double"))


def rank_within_ranged(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    kind: str = "rank",
    name: str | None = None,
    num_partitions: int | None = None,
    stage: bool = False,
) -> DataFrame:
    """``rank`` / ``dense_rank`` / ``row_number`` with large partitions split over tasks."""
    return rankings_ranged(df, partition_cols, order_cols, {name or kind: kind}, (), num_partitions, stage)


def rankings_ranged(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    kinds: dict[str, str],
    tie_breakers: OrderSpec = (),
    num_partitions: int | None = None,
    stage: bool = False,
) -> DataFrame:
    """Several rankings (``{column: kind}``) from one range split.

    Tied rows share a range: global rank = local rank + rows of the key in earlier ranges,
    global dense rank = local dense rank + distinct order values of the key in earlier
    ranges. ``tie_breakers`` order tied rows for ``row_number`` only.
    """
    keys = list(partition_cols)
    split, cut = _split(_staged(df, stage), keys, order_cols, num_partitions)
    w = Window.partitionBy("_range", *keys).orderBy(*order_cols)
    total = Window.partitionBy("_range", *keys).orderBy(*order_cols, *tie_breakers)
    fn = {"rank": lambda: F.rank().over(w), "dense_rank": lambda: F.dense_rank().over(w),
          "row_number": lambda: F.row_number().over(total)}
    local = split.withColumns({name: fn[kind]().cast("long") for name, kind in kinds.items()})
    if cut:
        dense = F.lit(0)
        hot = split.filter("_range > 0")
        if "dense_rank" in kinds.values():
            hot, dense = hot.withColumn("_d", F.dense_rank().over(w)), F.max("_d")
        segments = hot.groupBy("_range", *keys).agg(F.count(F.lit(1)).alias("_rows"), dense.alias("_values"))
        local = _with_segments(local, _before(segments, keys, ["_rows", "_values"]), ["_range", *keys])
        for name, kind in kinds.items():
            local = local.withColumn(name, F.col(name) + F.coalesce("_values" if kind == "dense_rank" else "_rows", F.lit(0)))
    return local.select(*df.columns, *kinds)


def bounded_window_ranged(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: OrderSpec,
    build,
    preceding: int,
    following: int,
    num_partitions: int | None = None,
    stage: bool = False,
) -> DataFrame:
    """Evaluate window columns whose frames reach at most ``preceding`` rows back and
    ``following`` rows ahead (lag, lead, moving averages), with hot keys split.

    ``build(w)`` returns ``{name: Column}`` for a window spec ``w`` (partitioned and
    ordered). Values are computed per (range, key) segment; only rows within
    ``preceding`` of a hot key's segment start or ``following`` of its end can see rows of
    a neighbouring range. Those rows are recomputed from the edge rows of its segments (at
    most ``segments x 2 x (preceding + following)`` rows) and patched in.
    """
    keys = list(partition_cols)
    reach = preceding + following
    split, cut = _split(_staged(df, stage), keys, order_cols, num_partitions)
    w = Window.partitionBy("_range", *keys).orderBy(*order_cols)
    cols = build(w)
    if not cut:
        return split.withColumns(cols).select(*df.columns, *cols)
    place = {"_pos": F.row_number().over(w), "_cnt": F.count(F.lit(1)).over(Window.partitionBy("_range", *keys))}
    edges = split.filter("_range > 0").withColumns(place).filter(
        (F.col("_pos") <= reach) | (F.col("_pos") > F.col("_cnt") - reach))
    fixed = (
        edges.withColumns(build(Window.partitionBy(*keys).orderBy("_range", "_pos")))
        .filter((F.col("_pos") <= preceding) | (F.col("_pos") > F.col("_cnt") - following))
        .select("_range", *keys, "_pos", F.lit(True).alias("_fixed"),
                *[F.col(c).alias(f"_fix_{c}") for c in cols])
    )
    local = split.withColumns({"_pos": place["_pos"]} | cols)
    # its rows grow with the frame, which the caller chooses: Spark picks the join
    out = _with_segments(local, fixed, ["_range", *keys, "_pos"])
    out = out.withColumns({c: F.when(F.col("_fixed"), F.col(f"_fix_{c}")).otherwise(F.col(c)) for c in cols})
    return out.select(*df.columns, *cols)
