"""Dedup and data-quality queries over the dirty order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.operators.aggregates import duplicate_keys
from tablecraft.operators.dedup import dedup_any, dedup_latest, distinct_keys
from tablecraft.operators.quality import dq_overview, duplicate_flag, order_rules, split_quality, tag_rows
from tablecraft.plans import logical as L
from tablecraft.plans.sql_views import sql
from tablecraft.sources.readers import read_parquet
from tablecraft.sources.scratch import scratch_path
from tablecraft.sources.sinks import route, write_quarantine

DUPE_KEYS = ["order_id", "line_no"]
QUARANTINE_DAY = "2024-01-15"


def q_dedup_any_keys(spark, sf):
    """Which row survives ``dropDuplicates`` is undefined, so only keys are returned."""
    return dedup_any(L.orders_dupes(spark, sf), DUPE_KEYS).select(*DUPE_KEYS)


def q_distinct_keys(spark, sf):
    return distinct_keys(L.orders_dupes(spark, sf), DUPE_KEYS)


def q_dedup_latest(spark, sf):
    return dedup_latest(L.orders_dupes(spark, sf), DUPE_KEYS, ["updated_at"])


def q_dq_tag_rows(spark, sf):
    df = duplicate_flag(L.orders_dirty(spark, sf), "order_id")
    rules = dict(order_rules())
    rules["is_null_order_date"] = F.col("order_date").isNull()
    return tag_rows(df, rules).select("order_id", "is_duplicate", *rules)


def q_dq_bad_records(spark, sf):
    return split_quality(L.orders_dirty(spark, sf), order_rules())[1]


def q_dq_good_records(spark, sf):
    return split_quality(L.orders_dirty(spark, sf), order_rules())[0]


def q_dq_routed(spark, sf):
    """Good and bad rows from one write routed by verdict, read back side by side."""
    good, bad, _ = route(L.orders_dirty(spark, sf), order_rules(), scratch_path(spark, "routed"))
    return good.withColumn("verdict", F.lit("good")).unionByName(bad.withColumn("verdict", F.lit("bad")))


def q_dq_duplicate_keys(spark, sf):
    return duplicate_keys(L.orders_dirty(spark, sf), "order_id")


def q_dq_clean(spark, sf):
    """Good rows, one per order id: latest order date, ties broken by the other columns."""
    good = split_quality(L.orders_dirty(spark, sf), order_rules())[0]
    return dedup_latest(good, ["order_id"], ["order_date"])


def q_dq_overview(spark, sf):
    return dq_overview(L.orders_dirty(spark, sf), order_rules(), "order_id")


def q_dq_quarantine(spark, sf):
    """Bad rows written to a quarantine sink partitioned by a fixed processing date,
    read back from storage."""
    bad = split_quality(L.orders_dirty(spark, sf), order_rules())[1]
    path = write_quarantine(bad, scratch_path(spark, "quarantine"), QUARANTINE_DAY)
    return read_parquet(spark, path)


QUERIES = {
    "dedup_any_keys": q_dedup_any_keys,
    "distinct_keys": q_distinct_keys,
    "dedup_latest": q_dedup_latest,
    "dq_tag_rows": q_dq_tag_rows,
    "dq_bad_records": q_dq_bad_records,
    "dq_good_records": q_dq_good_records,
    "dq_routed": q_dq_routed,
    "dq_duplicate_keys": q_dq_duplicate_keys,
    "dq_clean": q_dq_clean,
    "dq_overview": q_dq_overview,
    "dq_quarantine": q_dq_quarantine,
}

_BAD = """(customer_id IS NULL OR product IS NULL OR quantity IS NULL OR quantity < 0
   OR price IS NULL OR status IS NULL OR status NOT IN ('COMPLETED','PENDING','CANCELLED'))"""
_DIRTY_COLS = "order_id, customer_id, product, quantity, price, status, order_date"

ORACLE = {
    "dedup_any_keys": sql(["orders_dupes"], "SELECT DISTINCT order_id, line_no FROM orders_dupes"),
    "distinct_keys": sql(["orders_dupes"], "SELECT DISTINCT order_id, line_no FROM orders_dupes"),
    "dedup_latest": sql(["orders_dupes"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, line_no
      ORDER BY updated_at DESC, part_id DESC, supplier_id DESC, quantity DESC, extended_price DESC,
               discount DESC, tax DESC, return_flag DESC, line_status DESC) AS rn
  FROM orders_dupes) t WHERE rn = 1"""),
    "dq_tag_rows": sql(["orders_dirty"], """
SELECT order_id,
       COALESCE(COUNT(order_id) OVER (PARTITION BY order_id) > 1, false) AS is_duplicate,
       customer_id IS NULL AS is_null_customer_id,
       product IS NULL AS is_null_product,
       (quantity IS NULL OR quantity < 0) AS is_negative_quantity,
       price IS NULL AS is_null_price,
       (status IS NULL OR status NOT IN ('COMPLETED','PENDING','CANCELLED')) AS is_invalid_status,
       order_date IS NULL AS is_null_order_date
FROM orders_dirty"""),
    "dq_bad_records": sql(["orders_dirty"], f"SELECT {_DIRTY_COLS} FROM orders_dirty WHERE {_BAD}"),
    "dq_good_records": sql(["orders_dirty"], f"SELECT {_DIRTY_COLS} FROM orders_dirty WHERE NOT {_BAD}"),
    "dq_routed": sql(["orders_dirty"], f"""
SELECT {_DIRTY_COLS}, CASE WHEN {_BAD} THEN 'bad' ELSE 'good' END AS verdict FROM orders_dirty"""),
    "dq_duplicate_keys": sql(["orders_dirty"], """
SELECT order_id, COUNT(order_id) AS occurrence_count FROM orders_dirty
GROUP BY order_id HAVING COUNT(order_id) > 1"""),
    "dq_clean": sql(["orders_dirty"], f"""
SELECT {_DIRTY_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
      ORDER BY order_date DESC, customer_id DESC, product DESC, quantity DESC, price DESC, status DESC) AS rn
  FROM orders_dirty WHERE NOT {_BAD}) t WHERE rn = 1"""),
    "dq_overview": sql(["orders_dirty"], f"""
SELECT COUNT(*) AS total,
       COUNT(*) FILTER (WHERE NOT {_BAD}) AS good,
       COUNT(*) FILTER (WHERE {_BAD}) AS bad,
       COUNT(*) FILTER (WHERE NOT {_BAD}) - COUNT(DISTINCT CASE WHEN NOT {_BAD} THEN order_id END)
           AS duplicates_removed
FROM orders_dirty"""),
    "dq_quarantine": sql(["orders_dirty"], f"""
SELECT {_DIRTY_COLS}, DATE '{QUARANTINE_DAY}' AS quarantine_date FROM orders_dirty WHERE {_BAD}"""),
}
