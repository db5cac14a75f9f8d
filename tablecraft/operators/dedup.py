"""Deduplication and slowly-changing-dimension (type 2) operators.

``dedup_latest`` is ``row_number() = 1`` over the key, which Spark plans with a partial
window group limit before the shuffle: each input task keeps one row per key, so a hot
key is reduced map-side instead of being sorted whole in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key (``dropDuplicates``); which row survives is undefined."""
    return df.dropDuplicates(list(keys))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct key tuples."""
    return df.select(*keys).distinct()


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str | Column],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order_cols`` per key.

    ``order_cols`` may be column expressions (e.g. a parsed date). Ties are broken by
    ``tie_breakers`` (default: every other column, in order, greatest first), so the
    survivor is deterministic. Null order values lose to non-null ones.

    Planned as ``row_number() = 1``: Spark inserts a partial window group limit
    *before* the shuffle, so every map task forwards at most one row per key and a key
    repeated a billion times never reaches one task whole.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    tie = list(tie_breakers) if tie_breakers is not None else rest
    ordering = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order_cols]
    ordering += [F.col(c).desc_nulls_last() for c in tie]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def scd2_build(
    changes: DataFrame,
    keys: Sequence[str],
    effective_col: str,
    from_name: str = "effective_from",
    to_name: str = "effective_to",
) -> DataFrame:
    """Validity intervals from one row per (key, effective date).

    ``effective_to`` = next version's start - 1 day (null for the current version), so
    consecutive versions never share a day; ``is_current`` = ``effective_to`` is null.
    The window holds one row per version of one key, bounded by the number of dates.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(effective_col))
    nxt = F.lead(F.col(effective_col), 1).over(w)
    return (
        changes.withColumn(to_name, F.date_sub(nxt, 1))
        .withColumnRenamed(effective_col, from_name)
        .withColumn("is_current", F.col(to_name).isNull())
    )


def scd2_current(dim: DataFrame, flag: str = "is_current") -> DataFrame:
    """The current version of every key."""
    return dim.filter(F.col(flag))


def scd2_as_of(
    dim: DataFrame,
    as_of: dt.date | str,
    from_col: str = "effective_from",
    to_col: str = "effective_to",
) -> DataFrame:
    """Versions valid on ``as_of``: ``from <= d`` and (``to`` null or ``to >= d``)."""
    d = F.lit(as_of).cast("date")
    return dim.filter((F.col(from_col) <= d) & (F.col(to_col).isNull() | (F.col(to_col) >= d)))
