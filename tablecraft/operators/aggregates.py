"""Aggregations: grouped revenue, null audit, summary statistics, key skew.

All of them are single ``agg`` passes; Spark combines partial aggregates map-side
before the shuffle, so a hot key costs one partial row per input partition, never a
task holding all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.columns import money_mean, money_sum


def revenue_summary(
    df: DataFrame,
    keys: Sequence[str],
    value_col: str,
    count_col: str | None = None,
    distinct_count: bool = False,
) -> DataFrame:
    """``order_count``, exact ``total_revenue`` and ``avg_order_value`` per group.

    ``count_col`` counts non-null values of that column (distinct when asked);
    by default rows are counted.
    """
    if count_col is None:
        cnt = F.count(F.lit(1))
    elif distinct_count:
        cnt = F.count_distinct(F.col(count_col))
    else:
        cnt = F.count(F.col(count_col))
    aggs = [
        cnt.alias("order_count"),
        money_sum(value_col).alias("total_revenue"),
        money_mean(value_col).alias("avg_order_value"),
    ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count of every column in one pass, long form ``(column_name, null_count)``."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "null_count")


#: Accuracy of the approximate percentiles that narrow the search for an exact one.
_ACCURACY = 10_000
_MOMENTS = ("count", "mean", "stddev", "min", "max")


def _near(p: float) -> list[float]:
    """Probabilities around ``p`` between which an approximate percentile at ``p`` must lie."""
    return [max(p - 2 / _ACCURACY, 0.0), p, min(p + 2 / _ACCURACY, 1.0)]


def _less(a: float, b: float) -> bool:
    """Spark's order of doubles: NaN is the largest."""
    return (math.isnan(a), a) < (math.isnan(b), b) if not math.isnan(a) else False


def _order_statistics(df: DataFrame, sought: dict[str, set[int]], first: dict[str, list[float]], counts: dict[str, int]) -> dict[str, dict[int, float]]:
    """The values at the given places (from 0) of the sorted non-null values of every column.

    Approximate percentiles of what is left of a column name candidates, and an exact count of
    the values below and up to each candidate finds the place or narrows the range around it
    to a few ten-thousandths. Each round is two aggregates over one scan, for all columns and
    places together; a task sends one row. ``first`` holds the candidates of the first round.
    """
    found: dict[str, dict[int, float]] = {c: {} for c in sought}
    # per column and place: an open range of values (None: no bound) and the values up to its lower end
    ranges = {(c, k): (None, None, 0, counts[c]) for c, ks in sought.items() for k in ks}
    candidates = {c: set(first[c]) for c in sought}
    while ranges:
        tests = sorted({(c, v) for c, vs in candidates.items() for v in vs}, key=str)
        x = {c: F.col(c).cast("double") for c in sought}
        row = df.agg(*[F.count_if(x[c] < F.lit(v)) for c, v in tests], *[F.count_if(x[c] <= F.lit(v)) for c, v in tests]).first()
        below = {t: (row[i], row[len(tests) + i]) for i, t in enumerate(tests)}
        for (c, k), (lo, hi, n_lo, inside) in list(ranges.items()):
            n_hi = n_lo + inside
            for v in candidates[c]:
                lt, le = below[c, v]
                if lt <= k < le:
                    found[c][k] = v
                    del ranges[c, k]
                    break
                if le <= k and le >= n_lo and (lo is None or _less(lo, v)):
                    lo, n_lo = v, le
                elif lt > k and lt <= n_hi and (hi is None or _less(v, hi)):
                    hi, n_hi = v, lt
            else:
                ranges[c, k] = (lo, hi, n_lo, n_hi - n_lo)
        groups: dict[tuple, set[float]] = {}
        for (c, k), (lo, hi, n_lo, inside) in ranges.items():
            groups.setdefault((c, lo, hi), set()).update(_near((k - n_lo + 0.5) / inside))
        if groups:
            aggs = []
            for (c, lo, hi), ps in groups.items():
                inner = F.lit(True) if lo is None else x[c] > F.lit(lo)
                inner = inner if hi is None else inner & (x[c] < F.lit(hi))
                aggs.append(F.percentile_approx(F.when(inner, x[c]), sorted(ps), _ACCURACY))
            row = df.agg(*aggs).first()
            candidates = {c: set() for c in sought}
            for i, (c, _, _) in enumerate(groups):
                candidates[c].update(row[i])
    return found


def _profile(df: DataFrame, columns: Sequence[str], probs: dict[str, float]) -> dict[str, dict[str, float | None]]:
    """Moments and exact quantiles of every column."""
    aggs, ps = [], sorted({q for p in probs.values() for q in _near(p)}) or [0.5]
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x), F.percentile_approx(x, ps, _ACCURACY)]
    row = df.agg(*aggs).first()
    out: dict[str, dict[str, float | None]] = {}
    sought, first, counts = {}, {}, {}
    for i, c in enumerate(columns):
        *moments, near = row[6 * i:6 * i + 6]
        out[c] = dict(zip(_MOMENTS, [float(moments[0]), *moments[1:]]))
        counts[c], first[c] = moments[0], near or []
        places = [(moments[0] - 1) * p for p in probs.values()] if moments[0] else []
        sought[c] = {min(k, moments[0] - 1) for at in places for k in (math.floor(at), math.floor(at) + 1)}
    found = _order_statistics(df, sought, first, counts)
    for c in columns:
        for name, p in probs.items():
            if not counts[c]:
                out[c][name] = None
                continue
            # same arithmetic as Spark's in-memory ``percentile`` (identical bits either way)
            at = (counts[c] - 1) * p
            lo = math.floor(at)
            hi = min(lo + 1, counts[c] - 1)
            low, high = found[c][lo], found[c][hi]
            out[c][name] = low if at == lo or low == high else (lo + 1 - at) * low + (at - lo) * high
    return out


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: dict[str, float],
    method: str = "narrowing",
) -> DataFrame:
    """Exact quantiles with linear interpolation (``quantile_cont`` semantics), long
    form ``(stat, value)``. No task holds or sorts the column: the places between which a
    quantile lies are found by narrowing (see :func:`_order_statistics`). Nulls are left out;
    NaN is the largest value. (SQL engines may round the interpolation differently: results
    can differ from theirs in the last bit.)

    ``method="memory"`` is Spark's exact ``percentile``, for columns known to have few
    distinct values (it holds a count per distinct value in one task).
    """
    if method == "memory":
        pct = F.percentile(F.col(column), list(probs.values()))
        return df.agg(*[pct[i].cast("double").alias(k) for i, k in enumerate(probs)]).unpivot(
            [], list(probs), "stat", "value"
        )
    stats = _profile(df, [column], probs)[column]
    return df.sparkSession.createDataFrame([(k, stats[k]) for k in probs], "stat string, value double")


def summary_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min, 25 %, 50 %, 75 %, max per column, long form.

    One pass gives the moments of all columns: count, mean and sum of squared deviations,
    merged between tasks about their means, so close values far from zero keep their
    spread. Percentiles are exact (:func:`exact_quantiles`), for all columns in the same
    passes. Only these figures come to the driver.
    """
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    stats = _profile(df, list(columns), probs)
    rows = [(c, name, stats[c][name]) for c in columns for name in (*_MOMENTS, *probs)]
    return df.sparkSession.createDataFrame(rows, "column_name string, stat string, value double")


def heavy_hashes(df: DataFrame, keys: Sequence[str], min_share: float) -> tuple[int, list[tuple[int, int]]]:
    """Rows of ``df``, and (hash, estimated rows) of the keys that may hold ``min_share`` or
    more of them: none of these is missed. A frequent-items sketch over hashes of the keys,
    merged from one row per task; its size goes by the inverse of the share, not by the number
    of keys. Two keys of equal hash count as one. Without keys all rows are one."""
    if not 1e-4 <= min_share <= 1:
        raise ValueError("min_share must be between 0.0001 and 1")
    if not keys:
        n = df.count()
        return n, [(0, n)] if n else []
    k = math.ceil(1 / min_share)
    tracked = min(1 << 20, 1 << math.ceil(math.log2(100 * k)))
    hashed = df.select(F.xxhash64(*keys).alias("h"))
    total, items = hashed.agg(F.count(F.lit(1)), F.expr(f"approx_top_k(h, {min(k, 10_000)}, {tracked})")).first()
    return total, [(r["item"], r["count"]) for r in items or [] if r["count"] >= min_share * total]


def heavy_keys(df: DataFrame, keys: Sequence[str], min_share: float = 0.01) -> DataFrame:
    """Keys with at least ``min_share`` of all rows, with their exact number of rows ``n``,
    largest first (ties by key). The candidates come from a sketch (:func:`heavy_hashes`), so
    only their rows are grouped, whatever the number of keys."""
    total, heavy = heavy_hashes(df, keys, min_share)
    counts = df.filter(F.xxhash64(*keys).isin([h for h, _ in heavy])).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.filter(F.col("n") >= F.lit(total * min_share))
    return counts.orderBy(F.col("n").desc(), *[F.col(k).asc_nulls_first() for k in keys])


def skew_report(df: DataFrame, keys: Sequence[str], min_share: float = 0.01) -> DataFrame:
    """The heavy keys in falling order, with their share of all rows."""
    total = df.count()
    return heavy_keys(df, keys, min_share).withColumn("share", F.col("n") / F.lit(max(total, 1)))


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and the ratio to the mean rows-per-key (``> 3`` reads as skewed)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total, keys = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    mean = (total or 0) / keys if keys else None
    return counts.withColumn("ratio_to_avg", F.col("n") / F.lit(mean))


def duplicate_keys(df: DataFrame, key: str, count_name: str = "occurrence_count") -> DataFrame:
    """Keys occurring more than once (HAVING ``count > 1``)."""
    return (
        df.groupBy(key)
        .agg(F.count(F.col(key)).alias(count_name))
        .filter(F.col(count_name) > 1)
    )
