"""Vectorised (Arrow-batched) UDF forms of the discount and category rules.

The built-in expressions in :mod:`tablecraft.functions.columns` are the fast path; the
pandas UDFs exist for callers that need a registered function name in SQL
(``SELECT apply_discount(v, code)``) and they give identical results; in both, NaN is
a missing value.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType

from tablecraft.functions.columns import (
    CATEGORY_BANDS,
    CATEGORY_LOWEST,
    DISCOUNT_FLAT500,
    DISCOUNT_SAVE10,
    DISCOUNT_WELCOME200,
)


@pandas_udf(DoubleType())
def apply_discount(value: pd.Series, code: pd.Series) -> pd.Series:
    v = value.astype("float64")
    c = code.str.upper()
    out = v.copy()
    out = out.where(~(c == DISCOUNT_SAVE10), v * 0.9)
    out = out.where(~(c == DISCOUNT_FLAT500), np.maximum(0.0, v - 500.0))
    out = out.where(~(c == DISCOUNT_WELCOME200), np.maximum(0.0, v - 200.0))
    return out.where(v.notna(), 0.0)


@pandas_udf(StringType())
def order_category_udf(value: pd.Series, status: pd.Series) -> pd.Series:
    v = value.astype("float64")
    conditions = [v.isna() | status.isna(), status != "COMPLETED"]
    choices = ["UNKNOWN", "NON_COMPLETED"]
    for floor, name in CATEGORY_BANDS:
        conditions.append(v >= floor)
        choices.append(name)
    return pd.Series(np.select(conditions, choices, default=CATEGORY_LOWEST), index=value.index)


def register(spark: SparkSession) -> None:
    """Register ``apply_discount`` and ``order_category`` for SQL and ``call_udf``."""
    spark.udf.register("apply_discount", apply_discount)
    spark.udf.register("order_category", order_category_udf)
