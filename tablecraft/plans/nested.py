"""Nested order documents: struct access, explode / explode_outer, totals, dimension."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.functions.columns import money_sum
from tablecraft.operators.nested import flatten_items, struct_columns
from tablecraft.plans import logical as L
from tablecraft.plans.sql_views import msum, sql
from tablecraft.sources.readers import read_json
from tablecraft.sources.scratch import scratch_path
from tablecraft.sources.sinks import write_json

ITEM_FIELDS = {
    "order_id": "order_id",
    "customer_id": "customer.id",
    "payment_status": "payment.status",
    "product": "item.product",
    "price": "item.price",
    "quantity": "item.quantity",
}


def q_nested_struct_access(spark, sf):
    """All fields of the customer and payment structs beside the order id. Names that say
    little alone (an id, a name) get the struct's name in front."""
    flat = struct_columns(L.transactions(spark, sf), ["customer", "payment"], {"id", "name", "method", "status"})
    return flat.drop("city", "items", "event_timestamp")


def q_nested_explode(spark, sf):
    """``explode`` drops orders whose item array is null or empty."""
    return flatten_items(L.transactions(spark, sf), "items", ITEM_FIELDS)


def q_nested_explode_outer(spark, sf):
    """``explode_outer`` keeps them as one row with null item fields."""
    flat = flatten_items(L.transactions(spark, sf), "items", ITEM_FIELDS, outer=True)
    return flat.withColumn("line_value", F.col("price") * F.col("quantity"))


def q_nested_totals(spark, sf):
    """Successful payments per customer and day: total, item count, and every product
    bought, repeats included, as a sorted list (one customer's lines of one day).

    The customer's attributes depend on the key, so they join after the aggregation.
    """
    paid = L.transactions(spark, sf).filter(F.col("payment.status") == "SUCCESS")
    lines = paid.select("customer_id", F.to_date("event_timestamp").alias("txn_date"), F.inline("items"))
    daily = lines.groupBy("customer_id", "txn_date").agg(
        money_sum(F.col("price") * F.col("quantity")).alias("total_amount"),
        F.count(F.lit(1)).alias("item_count"),
        F.array_join(F.sort_array(F.collect_list("product")), ",").alias("products"),
    )
    named = L.customers(spark, sf).select("customer_id", "customer_name", "tier")
    return daily.join(named, "customer_id", "left")


def q_nested_dim_customers(spark, sf):
    """Normalise: the distinct customer dimension out of the nested documents."""
    t = L.transactions(spark, sf)
    return t.select(
        F.col("customer.id").alias("customer_id"),
        F.col("customer.name").alias("customer_name"),
        F.col("customer.tier").alias("tier"),
        F.col("customer.city").alias("city"),
    ).dropDuplicates(["customer_id"])


def q_scan_json_nested(spark, sf):
    """Nested documents written as JSON lines and read back with an inferred schema."""
    path = write_json(L.transactions(spark, sf), scratch_path(spark, "transactions_json"))
    t = read_json(spark, path)
    return t.select(
        "order_id",
        F.col("customer.id").alias("customer_id"),
        F.col("payment.status").alias("payment_status"),
        F.coalesce(F.size("items"), F.lit(-1)).cast("long").alias("n_items"),
    )


def q_scan_json_props(spark, sf):
    """A JSON string column parsed with an explicit schema (``from_json``)."""
    e = L.table(spark, sf, "events").select("event_id", "props")
    return e.select("event_id", F.from_json("props", "k long").getField("k").alias("k"))


QUERIES = {
    "nested_struct_access": q_nested_struct_access,
    "nested_explode": q_nested_explode,
    "nested_explode_outer": q_nested_explode_outer,
    "nested_totals": q_nested_totals,
    "nested_dim_customers": q_nested_dim_customers,
    "scan_json_nested": q_scan_json_nested,
    "scan_json_props": q_scan_json_props,
}

_ITEMS = "SELECT order_id, customer_id, payment_status, product, price, quantity FROM txn_items"

ORACLE = {
    "nested_struct_access": sql(["customers"], """
SELECT o.o_orderkey AS order_id, c.customer_id, c.customer_name, c.tier,
       o.o_orderpriority AS payment_method,
       CASE WHEN o.o_orderpriority = '5-LOW' THEN 'FAILED' ELSE 'SUCCESS' END AS payment_status,
       o.o_totalprice AS amount
FROM orders o LEFT JOIN customers c ON c.customer_id = o.o_custkey"""),
    "nested_explode": sql(["txn_items"], _ITEMS + " WHERE product IS NOT NULL"),
    "nested_explode_outer": sql(["txn_items"], """
SELECT order_id, customer_id, payment_status, product, price, quantity, price * quantity AS line_value FROM txn_items"""),
    "nested_totals": sql(["txn_items"], f"""
SELECT customer_id, customer_name, tier, CAST(event_timestamp AS DATE) AS txn_date,
       {msum('price * quantity')} AS total_amount, COUNT(*) AS item_count,
       array_to_string(list_sort(list(product)), ',') AS products
FROM txn_items WHERE product IS NOT NULL AND payment_status = 'SUCCESS'
GROUP BY customer_id, customer_name, tier, CAST(event_timestamp AS DATE)"""),
    "nested_dim_customers": sql(["customers"], """
SELECT DISTINCT c.customer_id, c.customer_name, c.tier, c.city
FROM orders o LEFT JOIN customers c ON c.customer_id = o.o_custkey"""),
    "scan_json_nested": sql(["customers"], """
SELECT o.o_orderkey AS order_id, c.customer_id,
       CASE WHEN o.o_orderpriority = '5-LOW' THEN 'FAILED' ELSE 'SUCCESS' END AS payment_status,
       COALESCE(i.n, -1) AS n_items
FROM orders o
LEFT JOIN customers c ON c.customer_id = o.o_custkey
LEFT JOIN (SELECT l.l_orderkey, COUNT(*) AS n FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
           GROUP BY l.l_orderkey) i ON i.l_orderkey = o.o_orderkey"""),
    "scan_json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
}
