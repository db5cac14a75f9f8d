"""Column expressions built only from ``pyspark.sql.functions`` (JVM side, codegen).

Money is held as ``double`` in the tables, but every *sum* goes through
``decimal(18,2)`` so the total does not depend on the order in which partitions are
combined: the same query gives the same bits on every run, on any cluster size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values of the order domain (must equal the reference's rule set).
VALID_STATUSES = ["COMPLETED", "PENDING", "CANCELLED"]
STATUS_BY_CODE = {"F": "COMPLETED", "O": "PENDING", "P": "CANCELLED"}
# Discount codes: multiplier or flat amount; matching is case-insensitive.
DISCOUNT_SAVE10 = "SAVE10"  # value * 0.9
DISCOUNT_FLAT500 = "FLAT500"  # max(0, value - 500)
DISCOUNT_WELCOME200 = "WELCOME200"  # max(0, value - 200)
# Category thresholds on a completed order's value.
CATEGORY_BANDS = [(100000.0, "PREMIUM"), (50000.0, "HIGH"), (10000.0, "MEDIUM")]
CATEGORY_LOWEST = "LOW"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: ColumnOrName) -> Column:
    """Exact two-decimal value of a double amount."""
    return _col(c).cast("decimal(18,2)")


def money_sum(c: ColumnOrName) -> Column:
    """Order-independent sum of a double amount, returned as double."""
    return F.sum(money(c)).cast("double")


def money_mean(c: ColumnOrName) -> Column:
    """Exact-sum mean: ``double(sum) / count`` (nulls ignored, like ``avg``)."""
    return F.sum(money(c)).cast("double") / F.count(_col(c))


def round2(c: ColumnOrName) -> Column:
    """Round half-up to cents on the decimal value, returned as double."""
    return F.round(_col(c).cast("decimal(38,10)"), 2).cast("double")


def status_from_code(c: ColumnOrName) -> Column:
    """TPC-style one-letter order status to the order-domain status word."""
    c = _col(c)
    expr = None
    for code, word in STATUS_BY_CODE.items():
        expr = F.when(c == code, F.lit(word)) if expr is None else expr.when(c == code, F.lit(word))
    return expr


def parse_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Date parse that yields null for malformed text (ANSI mode would raise)."""
    return F.try_to_date(_col(c), fmt) if fmt else F.try_to_date(_col(c))


def parse_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Timestamp parse that yields null for malformed text."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))


def discount(value: ColumnOrName, code: ColumnOrName) -> Column:
    """Discounted order value as a built-in expression.

    null or NaN value -> 0.0; null or unknown code -> value; codes are case-insensitive.
    """
    v, c = _col(value).cast("double"), F.upper(_col(code))
    return (
        F.when(v.isNull() | F.isnan(v), F.lit(0.0))
        .when(c.isNull(), v)
        .when(c == DISCOUNT_SAVE10, v * F.lit(0.9))
        .when(c == DISCOUNT_FLAT500, F.greatest(F.lit(0.0), v - F.lit(500.0)))
        .when(c == DISCOUNT_WELCOME200, F.greatest(F.lit(0.0), v - F.lit(200.0)))
        .otherwise(v)
    )


def order_category(value: ColumnOrName, status: ColumnOrName) -> Column:
    """Order category: UNKNOWN for null or NaN inputs first, then status, then value bands."""
    v, s = _col(value).cast("double"), _col(status)
    expr = F.when(v.isNull() | F.isnan(v) | s.isNull(), F.lit("UNKNOWN")).when(
        s != F.lit("COMPLETED"), F.lit("NON_COMPLETED")
    )
    for floor, name in CATEGORY_BANDS:
        expr = expr.when(v >= F.lit(floor), F.lit(name))
    return expr.otherwise(F.lit(CATEGORY_LOWEST))


def hash_bucket(n: int, *cols: ColumnOrName) -> Column:
    """Deterministic bucket in ``[0, n)``: the same on every task retry (unlike rand)."""
    return F.pmod(F.xxhash64(*[_col(c) for c in cols]), F.lit(n)).cast("int")
