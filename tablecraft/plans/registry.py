"""All registered queries and their oracle SQL, collected from the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablecraft.plans import e2e, io, joins, nested, quality, relational, streams, tables, windows

_MODULES = [e2e, relational, joins, quality, windows, nested, io, tables, streams]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
