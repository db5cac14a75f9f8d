"""Join queries: strategies, salting, bucketing, temporal / SCD-2, referential checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablecraft.operators.aggregates import key_skew, skew_report
from tablecraft.operators.dedup import scd2_as_of, scd2_current
from tablecraft.operators.joins import bounded_broadcast, hot_keys, join, orphans, salted_join, salted_sides, temporal_join
from tablecraft.plans import logical as L
from tablecraft.plans.sql_views import sql
from tablecraft.sources.sinks import write_bucketed

ENRICHED = ["order_id", "customer_id", "customer_name", "city", "tier", "product", "quantity", "price", "status"]


def _enriched(spark, sf, how="inner", strategy="auto"):
    return join(L.orders_v2(spark, sf), L.customers(spark, sf), "customer_id", how, strategy).select(*ENRICHED)


def q_join_inner(spark, sf):
    """Plain equi-join: Catalyst/AQE pick broadcast or sort-merge from runtime sizes."""
    return _enriched(spark, sf, "inner")


def q_join_left(spark, sf):
    return _enriched(spark, sf, "left")


def q_join_broadcast(spark, sf):
    """Broadcast the customer side, but only after checking its estimated size."""
    return _enriched(spark, sf, "inner", "broadcast")


def q_join_broadcast_sql(spark, sf):
    """The SQL ``BROADCAST`` hint, issued only when the hinted side passed the size check."""
    o, c = f"o_{uuid.uuid4().hex[:8]}", f"c_{uuid.uuid4().hex[:8]}"
    L.orders_v2(spark, sf).createOrReplaceTempView(o)
    cust = L.customers(spark, sf)
    cust.createOrReplaceTempView(c)
    small = bounded_broadcast(cust) is not cust
    hint = "/*+ BROADCAST(c) */" if small else ""
    return spark.sql(f"""
        SELECT {hint} o.order_id, o.customer_id, c.customer_name, c.city, c.tier,
               o.product, o.quantity, o.price, o.status
        FROM {o} o JOIN {c} c ON o.customer_id = c.customer_id""")


def q_join_merge_hint(spark, sf):
    return _enriched(spark, sf, "inner", "merge")


def q_enriched_orders(spark, sf):
    """Completed orders with all of their customer's columns and the order value."""
    done = L.orders_v2(spark, sf).filter(F.col("status") == "COMPLETED").drop("status")
    value = (F.col("quantity") * F.col("price")).alias("order_value")
    return join(done, L.customers(spark, sf), "customer_id").select("*", value)


SKEW_COLS = ["order_id", "customer_id", "customer_name", "tier", "amount"]


def q_join_salted(spark, sf):
    """Hot customer keys (>= 5 % of rows) are split over all shuffle partitions; others join
    unsalted."""
    big = L.orders_skewed(spark, sf)
    small = L.customers(spark, sf).select("customer_id", "customer_name", "tier")
    hot = hot_keys(big, ["customer_id"], min_share=0.05)
    return salted_join(big, small, ["customer_id"], hot=hot).select(*SKEW_COLS)


def q_join_skew_aqe(spark, sf):
    """Shuffle join on the skewed key; AQE's skew-join rule splits the hot partition."""
    big = L.orders_skewed(spark, sf)
    small = L.customers(spark, sf).select("customer_id", "customer_name", "tier")
    return join(big, small, "customer_id", "inner", "merge").select(*SKEW_COLS)


def q_key_skew(spark, sf):
    return key_skew(L.orders_skewed(spark, sf), "customer_id")


def q_skew_report(spark, sf):
    """Customers with a thousandth of all orders or more, largest first, found by a sketch."""
    return skew_report(L.orders_skewed(spark, sf), ["customer_id"], min_share=0.001)


def q_bucketed_join(spark, sf, buckets: int | None = None):
    """Both sides bucketed and sorted on the customer key: the join has no exchange.

    Default bucket count: the shuffle partition count.
    """
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = L.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = L.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    ot = write_bucketed(o.withColumnRenamed("o_custkey", "custkey"), "bucketed_orders", n, "custkey")
    ct = write_bucketed(c.withColumnRenamed("c_custkey", "custkey"), "bucketed_customers", n, "custkey")
    return spark.table(ot).join(spark.table(ct), "custkey").select(
        "o_orderkey", F.col("custkey").alias("o_custkey"), "o_totalprice", "c_name", "c_mktsegment"
    )


def q_bucketed_skew_join(spark, sf, buckets: int | None = None):
    """Both sides written once, bucketed by the customer and a sub-key that spreads the rows
    of hot customers over many buckets (their one dimension row is written once per sub-key);
    the join reads them back without an exchange."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    big = L.orders_skewed(spark, sf)
    small = L.customers(spark, sf).select("customer_id", "customer_name", "tier")
    hot = hot_keys(big, ["customer_id"], min_share=0.05)
    sides = salted_sides(big, small, ["customer_id"], salts=n, hot=hot, name="sub_key")
    names = [write_bucketed(df, f"skew_{i}", n, ["customer_id", "sub_key"]) for i, df in enumerate(sides)]
    return spark.table(names[0]).join(spark.table(names[1]), ["customer_id", "sub_key"]).select(*SKEW_COLS)


def q_join_self(spark, sf):
    """Orders joined with a projection of themselves on the order key."""
    o = L.table(spark, sf, "orders")
    proj = o.select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("priority"))
    return o.join(proj, o.o_orderkey == proj.k).select("o_orderkey", "o_custkey", "o_totalprice", "priority")


def q_temporal_join(spark, sf, method="sweep"):
    """Each fact with the version valid at its time: an as-of sweep over versions that are
    shown not to overlap."""
    fact = L.temporal_facts(spark, sf)
    dim = L.customers_scd2(spark, sf).select("customer_id", "tier", "effective_from", "effective_to")
    out = temporal_join(fact, dim, ["customer_id"], "event_date", method=method)
    return out.select("order_id", "line_no", "customer_id", "event_date", F.col("tier").alias("tier_at_event"))


def q_temporal_join_interval(spark, sf):
    """The same by an equi-join with the interval as a condition, which allows overlaps."""
    return q_temporal_join(spark, sf, method="join")


def q_scd2_current(spark, sf):
    return scd2_current(L.customers_scd2(spark, sf)).select("customer_id", "tier", "effective_from")


POINT_IN_TIME = "1998-01-10"


def q_point_in_time(spark, sf):
    return scd2_as_of(L.customers_scd2(spark, sf), POINT_IN_TIME).select(
        "customer_id", "tier", "effective_from", "effective_to"
    )


def q_dq_orphans(spark, sf):
    return orphans(L.orders_dirty(spark, sf), L.customers(spark, sf), "customer_id").select(
        "order_id", "customer_id", "product", "status"
    )


QUERIES = {
    "join_inner": q_join_inner,
    "join_left": q_join_left,
    "join_broadcast": q_join_broadcast,
    "join_broadcast_sql": q_join_broadcast_sql,
    "join_merge_hint": q_join_merge_hint,
    "enriched_orders": q_enriched_orders,
    "join_salted": q_join_salted,
    "join_skew_aqe": q_join_skew_aqe,
    "key_skew": q_key_skew,
    "skew_report": q_skew_report,
    "bucketed_join": q_bucketed_join,
    "join_self": q_join_self,
    "temporal_join": q_temporal_join,
    "temporal_join_interval": q_temporal_join_interval,
    "bucketed_skew_join": q_bucketed_skew_join,
    "scd2_current": q_scd2_current,
    "point_in_time": q_point_in_time,
    "dq_orphans": q_dq_orphans,
}

_ENR = """SELECT o.order_id, o.customer_id, c.customer_name, c.city, c.tier, o.product, o.quantity, o.price, o.status
FROM orders_v2 o {how} JOIN customers c ON o.customer_id = c.customer_id"""
_SKEW = """SELECT o.order_id, o.customer_id, c.customer_name, c.tier, o.amount
FROM orders_skewed o JOIN customers c ON o.customer_id = c.customer_id"""

ORACLE = {
    "join_inner": sql(["orders_v2", "customers"], _ENR.format(how="INNER")),
    "join_left": sql(["orders_v2", "customers"], _ENR.format(how="LEFT")),
    "join_broadcast": sql(["orders_v2", "customers"], _ENR.format(how="INNER")),
    "join_broadcast_sql": sql(["orders_v2", "customers"], _ENR.format(how="INNER")),
    "join_merge_hint": sql(["orders_v2", "customers"], _ENR.format(how="INNER")),
    "enriched_orders": sql(["orders_v2", "customers"], """
SELECT *, quantity * price AS order_value
FROM (SELECT * EXCLUDE (status) FROM orders_v2 WHERE status = 'COMPLETED') o JOIN customers c USING (customer_id)"""),
    "join_salted": sql(["orders_skewed", "customers"], _SKEW),
    "join_skew_aqe": sql(["orders_skewed", "customers"], _SKEW),
    "skew_report": sql(["orders_skewed"], """
SELECT customer_id, COUNT(*) AS n, COUNT(*) / (SELECT COUNT(*) FROM orders_skewed)::DOUBLE AS share
FROM orders_skewed GROUP BY customer_id HAVING COUNT(*) >= 0.001 * (SELECT COUNT(*) FROM orders_skewed)"""),
    "key_skew": sql(["orders_skewed"], """
SELECT customer_id, n, n / AVG(n) OVER () AS ratio_to_avg FROM (
  SELECT customer_id, COUNT(*) AS n FROM orders_skewed GROUP BY customer_id) t"""),
    "bucketed_join": """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "join_self": """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, p.o_orderpriority AS priority
FROM orders o JOIN orders p ON o.o_orderkey = p.o_orderkey""",
    "bucketed_skew_join": sql(["orders_skewed", "customers"], _SKEW),
    "temporal_join": sql(["temporal_facts", "customers_scd2"], """
SELECT f.order_id, f.line_no, f.customer_id, f.event_date, d.tier AS tier_at_event
FROM temporal_facts f LEFT JOIN customers_scd2 d
  ON f.customer_id = d.customer_id AND f.event_date >= d.effective_from
 AND (d.effective_to IS NULL OR f.event_date <= d.effective_to)"""),
    "temporal_join_interval": sql(["temporal_facts", "customers_scd2"], """
SELECT f.order_id, f.line_no, f.customer_id, f.event_date, d.tier AS tier_at_event
FROM temporal_facts f LEFT JOIN customers_scd2 d
  ON f.customer_id = d.customer_id AND f.event_date >= d.effective_from
 AND (d.effective_to IS NULL OR f.event_date <= d.effective_to)"""),
    "scd2_current": sql(["customers_scd2"], "SELECT customer_id, tier, effective_from FROM customers_scd2 WHERE is_current"),
    "point_in_time": sql(["customers_scd2"], f"""
SELECT customer_id, tier, effective_from, effective_to FROM customers_scd2
WHERE effective_from <= DATE '{POINT_IN_TIME}' AND (effective_to IS NULL OR effective_to >= DATE '{POINT_IN_TIME}')"""),
    "dq_orphans": sql(["orders_dirty", "customers"], """
SELECT o.order_id, o.customer_id, o.product, o.status FROM orders_dirty o
WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = o.customer_id)"""),
}
