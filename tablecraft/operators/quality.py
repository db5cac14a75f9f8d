"""Rule-based data quality: tag, split, overview, quarantine stamp.

A rule is ``name -> Column`` that is true when the row has that issue. Rules are
evaluated null-safely: a rule that evaluates to null counts as an issue, so every
row lands in exactly one of the good / bad splits (good + bad = total).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.columns import VALID_STATUSES

Rules = Mapping[str, Column]


def order_rules(valid_statuses: Sequence[str] = VALID_STATUSES) -> dict[str, Column]:
    """The order-table rule set: null keys/values, negative quantity, bad status."""
    return {
        "is_null_customer_id": F.col("customer_id").isNull(),
        "is_null_product": F.col("product").isNull(),
        "is_negative_quantity": F.col("quantity").isNull() | (F.col("quantity") < 0),
        "is_null_price": F.col("price").isNull(),
        "is_invalid_status": F.col("status").isNull() | ~F.col("status").isin(list(valid_statuses)),
    }


def _safe(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(True))


def duplicate_flag(df: DataFrame, key: str, name: str = "is_duplicate") -> DataFrame:
    """Flag rows whose non-null key occurs more than once.

    Counted with a map-side-combined aggregate joined back on the key (AQE splits a
    hot key in that join), not a window that would sort all of a key's rows in one task.
    """
    counts = df.groupBy(key).agg(F.count(F.col(key)).alias("_key_rows"))
    return (
        df.join(counts, df[key].eqNullSafe(counts[key]), "left")
        .drop(counts[key])
        .withColumn(name, F.coalesce(F.col("_key_rows") > 1, F.lit(False)))
        .drop("_key_rows")
    )


def tag_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """Add one boolean column per rule (null-safe)."""
    return df.withColumns({name: _safe(rule) for name, rule in rules.items()})


def is_bad(rules: Rules) -> Column:
    """Whether a row has at least one issue."""
    bad = F.lit(False)
    for rule in rules.values():
        bad = bad | _safe(rule)
    return bad


def split_quality(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: bad has at least one issue, good is exactly the rest."""
    bad = is_bad(rules)
    return df.filter(~bad), df.filter(bad)


def dq_overview(df: DataFrame, rules: Rules, key: str) -> DataFrame:
    """Total / good / bad / duplicates-removed counts in one aggregation pass.

    ``duplicates_removed`` = good rows - distinct non-null keys among good rows.
    """
    bad = is_bad(rules)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~bad).alias("good"),
        F.count_if(bad).alias("bad"),
        (F.count_if(~bad) - F.count_distinct(F.when(~bad, F.col(key)))).alias("duplicates_removed"),
    )


def stamp_quarantine(df: DataFrame, day: dt.date | str | None = None, name: str = "quarantine_date") -> DataFrame:
    """Stamp rows with the processing date (a fixed ``day`` makes reruns reproducible)."""
    value = F.current_date() if day is None else F.lit(day).cast("date")
    return df.withColumn(name, value)
