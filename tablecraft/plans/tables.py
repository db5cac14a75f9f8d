"""Order table as plain Parquet: two overlapping order batches written, appended, merged,
deleted from, widened and compacted. Every state has its own folder, so an earlier one can
still be read.

Batch 1: orders dated before 1999 as first seen (all PENDING).
Batch 2: orders dated 1998 or later with their final status. The 1998 orders are
updated by the merge; the later ones are new.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.functions.columns import status_from_code
from tablecraft.operators import versions as V
from tablecraft.plans import logical as L
from tablecraft.plans.sql_views import STATUS_CASE
from tablecraft.sources import states as S
from tablecraft.sources.readers import read_parquet
from tablecraft.sources.scratch import scratch_path
from tablecraft.sources.sinks import write_parquet

KEYS = ["order_id"]
BATCH1_BEFORE = "1999-01-01"
BATCH2_FROM = "1998-01-01"


def _orders(spark, sf):
    return L.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status_from_code("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("order_date"),
    )


def batch1(spark, sf):
    return _orders(spark, sf).filter(F.col("order_date") < F.lit(BATCH1_BEFORE).cast("date")).withColumn(
        "status", F.lit("PENDING")
    )


def batch2(spark, sf):
    return _orders(spark, sf).filter(F.col("order_date") >= F.lit(BATCH2_FROM).cast("date"))


def _new_in_batch2(spark, sf):
    return batch2(spark, sf).filter(F.col("order_date") >= F.lit(BATCH1_BEFORE).cast("date"))


def _written(df):
    """Path of a new folder that holds ``df``."""
    return write_parquet(df, scratch_path(df.sparkSession, "order_table"))


def _appended(spark, sf):
    path = _written(batch1(spark, sf))
    return write_parquet(_new_in_batch2(spark, sf), path, mode="append")


def _merged(spark, sf, path=None):
    before = path or _written(batch1(spark, sf))
    return before, _written(V.upsert(read_parquet(spark, before), batch2(spark, sf), KEYS))


def q_table_append(spark, sf):
    """Plain append to a Parquet folder."""
    return read_parquet(spark, _appended(spark, sf))


def q_table_upsert(spark, sf):
    return read_parquet(spark, _merged(spark, sf)[1])


def _without_cancelled(spark, path):
    return _written(V.delete_where(read_parquet(spark, path), F.col("status") == "CANCELLED"))


def q_table_delete(spark, sf):
    return read_parquet(spark, _without_cancelled(spark, _merged(spark, sf)[1]))


def q_table_upsert_or_create(spark, sf):
    """The same call makes the table of the first batch and merges the second into it."""
    path = scratch_path(spark, "order_states")
    for batch in (batch1(spark, sf), batch2(spark, sf)):
        S.upsert_or_create(batch, path, KEYS)
    return S.read_latest(spark, path)


def q_table_time_travel(spark, sf):
    """Every order of the state before the merge, with its status after it: both states are
    still there."""
    path = scratch_path(spark, "order_states")
    first = S.write_state(batch1(spark, sf).unionByName(_new_in_batch2(spark, sf)), path)
    last = S.upsert_or_create(batch2(spark, sf), path, KEYS)
    states = S.committed(spark, path)
    after = S.read_state(spark, states[last]).select("order_id", F.col("status").alias("status_after"))
    return S.read_state(spark, states[first]).join(after, "order_id", "left")


def q_table_schema_change(spark, sf):
    """The whole merged table with a column more."""
    _, path = _merged(spark, sf)
    return read_parquet(spark, _written(read_parquet(spark, path).withColumn("discount", F.lit(0.0))))


def q_table_schema_union(spark, sf):
    """States of two schemas read as one table: rows written before the column was there
    have none."""
    older = _written(batch1(spark, sf))
    newer = _written(_new_in_batch2(spark, sf).withColumn("discount", F.when(F.col("amount") >= 100000, 5.0).otherwise(0.0)))
    return read_parquet(spark, older, newer, merge_schema=True)


def q_table_compact(spark, sf):
    """The appended table with small files packed together, without a shuffle."""
    return read_parquet(spark, _written(V.compacted(spark, _appended(spark, sf))))


def q_table_history(spark, sf):
    """Rows of the table after each step of its life."""
    first = _written(batch1(spark, sf))
    appended = write_parquet(_new_in_batch2(spark, sf), _written(read_parquet(spark, first)), mode="append")
    _, merged = _merged(spark, sf, appended)
    deleted = _without_cancelled(spark, merged)
    steps = {"WRITE": first, "APPEND": appended, "MERGE": merged, "DELETE": deleted,
             "OPTIMIZE": _written(V.compacted(spark, deleted))}
    out = None
    for i, (operation, path) in enumerate(steps.items()):
        rows = read_parquet(spark, path).agg(F.count(F.lit(1)).alias("row_count"))
        one = rows.select(F.lit(i).cast("long").alias("version"), F.lit(operation).alias("operation"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = {
    "table_append": q_table_append,
    "table_upsert": q_table_upsert,
    "table_delete": q_table_delete,
    "table_upsert_or_create": q_table_upsert_or_create,
    "table_time_travel": q_table_time_travel,
    "table_schema_union": q_table_schema_union,
    "table_schema_change": q_table_schema_change,
    "table_compact": q_table_compact,
    "table_history": q_table_history,
}

_O = f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       {STATUS_CASE.format(c='o_orderstatus')} AS status, o_totalprice AS amount,
       CAST(o_orderdate AS DATE) AS order_date FROM orders"""
_CTE = f"""WITH o AS ({_O}),
b1 AS (SELECT order_id, customer_id, 'PENDING' AS status, amount, order_date FROM o
       WHERE order_date < DATE '{BATCH1_BEFORE}'),
b2 AS (SELECT * FROM o WHERE order_date >= DATE '{BATCH2_FROM}'),
appended AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2 WHERE order_date >= DATE '{BATCH1_BEFORE}'),
merged AS (SELECT * FROM b1 WHERE order_id NOT IN (SELECT order_id FROM b2) UNION ALL SELECT * FROM b2),
merged_after_append AS (SELECT * FROM appended WHERE order_id NOT IN (SELECT order_id FROM b2)
                        UNION ALL SELECT * FROM b2)
"""

ORACLE = {
    "table_append": _CTE + "SELECT * FROM appended",
    "table_upsert": _CTE + "SELECT * FROM merged",
    "table_delete": _CTE + "SELECT * FROM merged WHERE NOT COALESCE(status = 'CANCELLED', false)",
    "table_upsert_or_create": _CTE + "SELECT * FROM merged",
    "table_time_travel": _CTE + """
SELECT a.*, m.status AS status_after FROM appended a LEFT JOIN merged_after_append m ON m.order_id = a.order_id""",
    "table_schema_union": _CTE + """
SELECT *, CAST(NULL AS DOUBLE) AS discount FROM b1 UNION ALL
SELECT *, CASE WHEN amount >= 100000 THEN 5.0::DOUBLE ELSE 0.0 END AS discount FROM b2 WHERE order_date >= DATE '""" + BATCH1_BEFORE + "'",
    "table_schema_change": _CTE + "SELECT *, CAST(0.0 AS DOUBLE) AS discount FROM merged",
    "table_compact": _CTE + "SELECT * FROM appended",
    "table_history": _CTE + """
SELECT * FROM (VALUES
  (CAST(0 AS BIGINT), 'WRITE', (SELECT COUNT(*) FROM b1)),
  (CAST(1 AS BIGINT), 'APPEND', (SELECT COUNT(*) FROM appended)),
  (CAST(2 AS BIGINT), 'MERGE', (SELECT COUNT(*) FROM merged_after_append)),
  (CAST(3 AS BIGINT), 'DELETE', (SELECT COUNT(*) FROM merged_after_append WHERE NOT COALESCE(status = 'CANCELLED', false))),
  (CAST(4 AS BIGINT), 'OPTIMIZE', (SELECT COUNT(*) FROM merged_after_append WHERE NOT COALESCE(status = 'CANCELLED', false)))
) h(version, operation, row_count)""",
}
