"""Physical layout: repartition, coalesce, cache scopes."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def round_robin(df: DataFrame, n: int) -> DataFrame:
    """Even partitions regardless of key (full shuffle)."""
    return df.repartition(n)


def by_key(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """Hash partitioning on ``cols``: a later join or aggregation on them is local."""
    return df.repartition(n, *cols)


def shrink(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle; never more than the input has."""
    return df.coalesce(n)


@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist ``df`` for the block, release it afterwards.

    ``MEMORY_AND_DISK`` spills instead of recomputing; a lost executor's blocks are
    recomputed from lineage.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
