"""Ranking and ordered-window queries over customer spend and order histories."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablecraft.functions.columns import money_sum
from tablecraft.operators.windows import (
    lag_delta,
    lag_pct_change,
    moving_average,
    rank_within,
    rankings_ranged,
    running_total,
)
from tablecraft.plans import logical as L
from tablecraft.plans.sql_views import msum, sql

ORDER = ["order_date", "order_id"]  # order id breaks date ties


def _completed(spark, sf):
    """Spend and order histories count completed orders only."""
    return L.orders_flat(spark, sf).filter(F.col("status") == "COMPLETED")


def spend_per_customer(spark, sf, how="inner"):
    """Total order value per customer with the customer's tier (an aggregate of a join).

    Orders are aggregated per customer *before* the join (name and tier depend on the
    customer key), so the join and its shuffle see one row per customer.
    """
    o = _completed(spark, sf).groupBy("customer_id").agg(money_sum("amount").alias("spend"))
    c = L.customers(spark, sf).select("customer_id", "customer_name", "tier")
    return o.join(c, "customer_id", how).select("customer_id", "customer_name", "tier", "spend")


def q_rank_in_tier(spark, sf):
    """Rank customers in their tier; a tier is split across tasks (few tiers, many
    customers each)."""
    return rank_within(spend_per_customer(spark, sf), ["tier"], [F.col("spend").desc()], "rank",
                       "rank_in_tier", ranged=True, stage=True)


def q_spend_dense_rank(spark, sf):
    """Left join: orders of unknown customers stay in a null-tier group."""
    return rank_within(spend_per_customer(spark, sf, "left"), ["tier"], [F.col("spend").desc()],
                       "dense_rank", "dense_rank_in_tier", ranged=True, stage=True)


def q_rank_three_ways(spark, sf):
    """rank, dense_rank and row_number side by side over a SQL derived table.

    Tiers are few and large, so they are split across tasks; one split serves all three.
    """
    v = f"spend_{uuid.uuid4().hex[:8]}"
    spend_per_customer(spark, sf).createOrReplaceTempView(v)
    spend = spark.sql(f"SELECT customer_id, tier, spend FROM (SELECT customer_id, tier, spend FROM {v}) t")
    kinds = {"rnk": "rank", "dense_rnk": "dense_rank", "row_num": "row_number"}
    return rankings_ranged(spend, ["tier"], [F.col("spend").desc()], kinds, tie_breakers=["customer_id"], stage=True)


def q_top_customer_per_tier(spark, sf):
    """Chained CTEs ending in a rank-1 filter (planned as a window group limit)."""
    o, c = f"o_{uuid.uuid4().hex[:8]}", f"c_{uuid.uuid4().hex[:8]}"
    _completed(spark, sf).createOrReplaceTempView(o)
    L.customers(spark, sf).createOrReplaceTempView(c)
    return spark.sql(f"""
        WITH order_values AS (
            SELECT customer_id, amount FROM {o}
        ), spend_by_key AS (
            SELECT customer_id, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS spend
            FROM order_values GROUP BY customer_id
        ), customer_spend AS (
            SELECT c.customer_id, c.customer_name, c.tier, s.spend
            FROM spend_by_key s JOIN {c} c ON s.customer_id = c.customer_id
        ), ranked AS (
            SELECT *, RANK() OVER (PARTITION BY tier ORDER BY spend DESC) AS rank_in_tier
            FROM customer_spend
        )
        SELECT customer_id, customer_name, tier, spend FROM ranked WHERE rank_in_tier = 1""")


def q_running_total(spark, sf):
    """Cumulative spend per customer; a customer with a huge history is split across
    tasks by range partitioning (see ``running_total_ranged``)."""
    o = _completed(spark, sf).select("order_id", "customer_id", "order_date", "amount")
    return running_total(o, ["customer_id"], ORDER, "amount", "running_total", ranged=True)


def q_lag_delta(spark, sf):
    o = _completed(spark, sf).select("order_id", "customer_id", "order_date", "amount")
    return lag_delta(o, ["customer_id"], ORDER, "amount", "prev_amount", "delta", ranged=True)


def q_lag_pct_change(spark, sf):
    o = _completed(spark, sf).select("order_id", "customer_id", "order_date", "amount")
    return lag_pct_change(o, ["customer_id"], ORDER, "amount", "prev_amount", "pct_change", ranged=True)


def q_moving_avg_7(spark, sf):
    o = _completed(spark, sf).select("order_id", "customer_id", "order_date", "amount")
    return moving_average(o, ["customer_id"], ORDER, "amount", 3, 3, "moving_avg_7", ranged=True)


QUERIES = {
    "rank_in_tier": q_rank_in_tier,
    "spend_dense_rank": q_spend_dense_rank,
    "rank_three_ways": q_rank_three_ways,
    "top_customer_per_tier": q_top_customer_per_tier,
    "running_total": q_running_total,
    "lag_delta": q_lag_delta,
    "lag_pct_change": q_lag_pct_change,
    "moving_avg_7": q_moving_avg_7,
}

_SPEND = ", spend AS (SELECT o.customer_id, c.customer_name, c.tier, " + msum("o.amount") + """ AS spend
  FROM (SELECT * FROM orders_flat WHERE status = 'COMPLETED') o {how} JOIN customers c ON o.customer_id = c.customer_id
  GROUP BY o.customer_id, c.customer_name, c.tier)
"""
_W = "OVER (PARTITION BY customer_id ORDER BY order_date, order_id"

ORACLE = {
    "rank_in_tier": sql(["orders_flat", "customers"], _SPEND.format(how="INNER") + """
SELECT customer_id, customer_name, tier, spend, RANK() OVER (PARTITION BY tier ORDER BY spend DESC) AS rank_in_tier FROM spend"""),
    "spend_dense_rank": sql(["orders_flat", "customers"], _SPEND.format(how="LEFT") + """
SELECT customer_id, customer_name, tier, spend, DENSE_RANK() OVER (PARTITION BY tier ORDER BY spend DESC) AS dense_rank_in_tier FROM spend"""),
    "rank_three_ways": sql(["orders_flat", "customers"], _SPEND.format(how="INNER") + """
SELECT customer_id, tier, spend,
       RANK() OVER (PARTITION BY tier ORDER BY spend DESC) AS rnk,
       DENSE_RANK() OVER (PARTITION BY tier ORDER BY spend DESC) AS dense_rnk,
       ROW_NUMBER() OVER (PARTITION BY tier ORDER BY spend DESC, customer_id) AS row_num
FROM spend"""),
    "top_customer_per_tier": sql(["orders_flat", "customers"], _SPEND.format(how="INNER") + """
SELECT customer_id, customer_name, tier, spend FROM (
  SELECT *, RANK() OVER (PARTITION BY tier ORDER BY spend DESC) AS r FROM spend) t WHERE r = 1"""),
    "running_total": sql(["orders_flat"], f"""
SELECT order_id, customer_id, order_date, amount,
       CAST(SUM(CAST(amount AS DECIMAL(18,2))) {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
           AS running_total
FROM orders_flat WHERE status = 'COMPLETED'"""),
    "lag_delta": sql(["orders_flat"], f"""
SELECT order_id, customer_id, order_date, amount, LAG(amount, 1) {_W}) AS prev_amount,
       amount - LAG(amount, 1) {_W}) AS delta
FROM orders_flat WHERE status = 'COMPLETED'"""),
    "lag_pct_change": sql(["orders_flat"], f"""
SELECT order_id, customer_id, order_date, amount, prev_amount,
       CASE WHEN prev_amount = 0 THEN NULL
            ELSE CAST(ROUND(CAST((amount - prev_amount) / prev_amount * 100.0 AS DECIMAL(38,10)), 2) AS DOUBLE) END
           AS pct_change
FROM (SELECT *, COALESCE(LAG(amount, 1) {_W}), 0.0) AS prev_amount FROM orders_flat WHERE status = 'COMPLETED') t"""),
    "moving_avg_7": sql(["orders_flat"], f"""
SELECT order_id, customer_id, order_date, amount,
       CAST(ROUND(CAST(CAST(SUM(CAST(amount AS DECIMAL(18,2))) {_W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS DOUBLE)
            / COUNT(amount) {_W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS DECIMAL(38,10)), 2) AS DOUBLE)
           AS moving_avg_7
FROM orders_flat WHERE status = 'COMPLETED'"""),
}
