"""Nested data: build nested order documents and flatten them back to line items."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nest_items(
    lines: DataFrame,
    keys: Sequence[str],
    item_fields: Sequence[str],
    name: str = "items",
) -> DataFrame:
    """One row per key with ``name`` = array of struct(item_fields).

    Groups are one order each (a handful of lines), so the arrays stay small.
    """
    return lines.groupBy(*keys).agg(
        F.collect_list(F.struct(*[F.col(f) for f in item_fields])).alias(name)
    )


def flatten_items(
    df: DataFrame,
    array_col: str,
    fields: Mapping[str, str | Column],
    outer: bool = False,
    item_alias: str = "item",
) -> DataFrame:
    """Explode ``array_col`` and project ``alias -> dotted path or Column``.

    ``outer=False`` drops rows whose array is null or empty (``explode``);
    ``outer=True`` keeps them once with null item fields (``explode_outer``).
    Paths may reference the exploded element as ``item.<field>``.
    """
    gen = F.explode_outer if outer else F.explode
    exploded = df.withColumn(item_alias, gen(F.col(array_col)))
    cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]
    return exploded.select(*cols)


def struct_columns(df: DataFrame, structs: Sequence[str], prefixed: Collection[str] = ()) -> DataFrame:
    """``df`` with the fields of the named struct columns in place of the structs, as the
    schema lists them. Fields in ``prefixed`` are named ``struct_field``; a field whose
    name is a column of ``df`` already is left out."""
    fields = [
        (c, f, f"{c}_{f}" if f in prefixed else f)
        for c in structs for f in df.schema[c].dataType.names
    ]
    own = [c for c in df.columns if c not in structs]
    return df.select(*own, *[F.col(f"{c}.{f}").alias(name) for c, f, name in fields if name not in own])
