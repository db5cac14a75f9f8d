"""Filters, projections, aggregations, sorts, SQL text queries, UDF reports."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.functions import udfs
from tablecraft.functions.columns import discount, money_sum, order_category, parse_date, round2
from tablecraft.operators.aggregates import null_audit, revenue_summary, summary_stats
from tablecraft.operators.joins import bounded_broadcast
from tablecraft.plans import logical as L
from tablecraft.plans.sql_views import mmean, msum, sql
from tablecraft.plans.sql_views import round2 as r2


def _view(df: DataFrame, stem: str) -> str:
    name = f"{stem}_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(name)
    return name


def completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "COMPLETED")


def with_order_value(df: DataFrame) -> DataFrame:
    return df.withColumn("order_value", F.col("quantity") * F.col("price"))


# ----------------------------------------------------------------- filter / project
def q_filter_status(spark, sf):
    return completed(L.orders_v2(spark, sf)).select("order_id", "customer_id", "product", "quantity", "price")


def q_order_value(spark, sf):
    return with_order_value(L.orders_v2(spark, sf)).select(
        "order_id", "product", "quantity", "price", "order_value"
    )


def q_date_parse(spark, sf):
    """Text dates (``dd-MM-yyyy``) with malformed entries parse to null, never raise."""
    o = L.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    text = F.when(F.col("o_orderkey") % 50 == 0, F.lit("n/a")).when(
        F.col("o_orderkey") % 50 == 25, F.concat(F.lit("32-"), F.date_format("o_orderdate", "MM-yyyy"))
    ).otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
    return o.select(F.col("o_orderkey").alias("order_id"), text.alias("date_text")).withColumn(
        "parsed_date", parse_date("date_text", "dd-MM-yyyy")
    )


# ----------------------------------------------------------------- UDF / rule columns
def q_category_case(spark, sf):
    df = with_order_value(L.orders_v3(spark, sf))
    return df.select("order_id", "order_value", "status", order_category("order_value", "status").alias("category"))


def q_category_udf(spark, sf):
    udfs.register(spark)
    df = with_order_value(L.orders_v3(spark, sf))
    return df.select(
        "order_id", "order_value", "status",
        F.call_udf("order_category", F.col("order_value"), F.col("status")).alias("category"),
    )


BUILT_IN = {"apply_discount": discount, "order_category": order_category}


def _priced(spark, orders: DataFrame, use_udf: bool) -> DataFrame:
    """Orders with their gross value, what the promotion takes off, and the category of
    the net value; the rules come as registered functions or as built-in expressions."""
    if use_udf:
        udfs.register(spark)
    rule = {name: partial(F.call_udf, name) if use_udf else BUILT_IN[name] for name in BUILT_IN}
    net = with_order_value(orders).withColumn(
        "discounted_value", rule["apply_discount"](F.col("order_value"), F.col("promo_code")))
    return net.withColumns({
        "category": rule["order_category"](F.col("discounted_value"), F.col("status")),
        "discount_amount": F.col("order_value") - F.col("discounted_value"),
    })


#: What the rules read and their results stand for.
RULE_INPUTS = ["quantity", "price", "status"]


def _priced_orders(spark, sf, use_udf):
    """Every column of the orders but the inputs of the rules, and all that the rules add."""
    return _priced(spark, L.orders_v3(spark, sf), use_udf).drop(*RULE_INPUTS)


def q_discount_builtin(spark, sf):
    return _priced_orders(spark, sf, use_udf=False)


def q_discount_udf(spark, sf):
    return _priced_orders(spark, sf, use_udf=True)


def grouped_report(spark, view: str, keys: list[str], sums: dict[str, str], where: str) -> DataFrame:
    """SQL report over ``view``: orders and the sums of the given measures (output name ->
    column, to the cent) per key, the first sum descending."""
    measures = ", ".join(f"CAST(ROUND(SUM(CAST({c} AS DECIMAL(18,4))), 2) AS DOUBLE) AS {name}" for name, c in sums.items())
    by = ", ".join(keys)
    return spark.sql(f"SELECT {by}, COUNT(order_id) AS order_count, {measures} FROM {view} WHERE {where} "
                     f"GROUP BY {by} ORDER BY {next(iter(sums))} DESC")


def q_discount_report(spark, sf):
    """Revenue before and after discounts, from a view whose columns are registered UDFs."""
    v = _view(_priced(spark, L.orders_v3(spark, sf), use_udf=True), "priced_orders")
    sums = {"gross_revenue": "order_value", "net_revenue": "discounted_value", "total_discount_given": "discount_amount"}
    return grouped_report(spark, v, ["product", "promo_code"], sums, "status = 'COMPLETED'")


# ----------------------------------------------------------------- aggregations
def q_revenue_by_product(spark, sf):
    df = with_order_value(completed(L.orders_v2(spark, sf)))
    return revenue_summary(df, ["product"], "order_value").withColumn(
        "avg_order_value", round2("avg_order_value")
    ).orderBy(F.col("total_revenue").desc())


def q_revenue_by_tier(spark, sf):
    """Pre-aggregated per customer before the join to the customer dimension, then
    rolled up per tier (exact decimal sums add up without rounding)."""
    df = with_order_value(completed(L.orders_v2(spark, sf)))
    per_customer = df.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("order_value").cast("decimal(18,2)")).alias("s")
    )
    tiers = per_customer.join(L.customers(spark, sf).select("customer_id", "tier"), "customer_id")
    out = tiers.groupBy("tier").agg(F.sum("n").alias("order_count"), F.sum("s").alias("_s"))
    return out.select(
        "tier", "order_count", F.col("_s").cast("double").alias("total_revenue"),
        round2(F.col("_s").cast("double") / F.col("order_count")).alias("avg_order_value"),
    )


def q_revenue_by_tier_product(spark, sf):
    o = _view(L.orders_v2(spark, sf), "orders_v2")
    c = _view(L.customers(spark, sf), "customers")
    return spark.sql(f"""
        WITH per_customer AS (
            SELECT customer_id, product, COUNT(*) AS n,
                   SUM(CAST(quantity * price AS DECIMAL(18,2))) AS s
            FROM {o} WHERE status = 'COMPLETED' GROUP BY customer_id, product
        )
        SELECT c.tier, p.product, SUM(p.n) AS order_count, CAST(SUM(p.s) AS DOUBLE) AS total_revenue,
               CAST(ROUND(CAST(CAST(SUM(p.s) AS DOUBLE) / SUM(p.n) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_order_value
        FROM per_customer p JOIN {c} c ON p.customer_id = c.customer_id
        GROUP BY c.tier, p.product
        ORDER BY c.tier, total_revenue DESC""")


def q_total_revenue(spark, sf):
    df = with_order_value(completed(L.orders_v2(spark, sf)))
    return revenue_summary(df, [], "order_value").withColumn("avg_order_value", round2("avg_order_value"))


def q_max_order_per_customer(spark, sf):
    """Left join keeps orders of unknown customers in a null-name group."""
    o = with_order_value(completed(L.orders_v2(spark, sf)))
    per_customer = o.groupBy("customer_id").agg(
        F.max("order_value").alias("max_order_value"), F.count(F.lit(1)).alias("order_count")
    )
    c = L.customers(spark, sf).select("customer_id", "customer_name")
    return per_customer.join(c, "customer_id", "left").select(
        "customer_id", "customer_name", "max_order_value", "order_count"
    )


def q_top_customers(spark, sf):
    """Top 10 customers by completed spend (limit is the feature: top-k report)."""
    df = with_order_value(completed(L.orders_v2(spark, sf)))
    spend = df.groupBy("customer_id").agg(money_sum("order_value").alias("total_spend"))
    return spend.orderBy(F.col("total_spend").desc(), F.col("customer_id").asc()).limit(10)


def q_summary_stats(spark, sf):
    """Statistics of numeric columns; mean and deviation to six places, as their last bits
    depend on the order in which tasks are merged."""
    o = summary_stats(L.table(spark, sf, "orders"), ["o_totalprice"])
    li = summary_stats(L.table(spark, sf, "lineitem"), ["l_quantity"])
    places = F.round(F.col("value").cast("decimal(38,10)"), 6).cast("double")
    return o.unionByName(li).withColumn("value", F.when(F.col("stat").isin("mean", "stddev"), places).otherwise(F.col("value")))


def q_null_audit(spark, sf):
    return null_audit(L.orders_dirty(spark, sf))


WORD_SPLIT = r"[ \t\n\r\f\x0B]+"


def q_word_count(spark, sf):
    """Case-sensitive word counts over the full text of every document."""
    words = L.table(spark, sf, "documents").select(F.explode(F.split(F.trim("text"), WORD_SPLIT)).alias("word"))
    return words.filter(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------- scans / views / SQL
def q_scan_parquet_count(spark, sf):
    parts = [
        L.table(spark, sf, t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(t).alias("table_name"), "row_count"
        )
        for t in L.TABLES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_view_session_count(spark, sf):
    name = f"orders_view_{uuid.uuid4().hex[:8]}"
    L.table(spark, sf, "orders").createOrReplaceTempView(name)
    out = spark.sql(f"SELECT o_orderstatus, COUNT(*) AS row_count FROM {name} GROUP BY o_orderstatus")
    spark.catalog.dropTempView(name)
    return out


def q_view_global_count(spark, sf):
    name = f"orders_view_{uuid.uuid4().hex[:8]}"
    L.table(spark, sf, "orders").createOrReplaceGlobalTempView(name)
    out = spark.sql(f"SELECT o_orderstatus, COUNT(*) AS row_count FROM global_temp.{name} GROUP BY o_orderstatus")
    spark.catalog.dropGlobalTempView(name)
    return out


def q_sql_join_order(spark, sf):
    o = _view(L.orders_v2(spark, sf), "orders_v2")
    c = _view(bounded_broadcast(L.customers(spark, sf)), "customers")
    return spark.sql(f"""
        SELECT o.order_id, c.customer_name, c.tier, o.product, o.quantity * o.price AS order_value
        FROM {o} o JOIN {c} c ON o.customer_id = c.customer_id
        WHERE o.status = 'COMPLETED'""")


QUERIES = {
    "filter_status": q_filter_status,
    "order_value": q_order_value,
    "date_parse": q_date_parse,
    "category_case": q_category_case,
    "category_udf": q_category_udf,
    "discount_builtin": q_discount_builtin,
    "discount_udf": q_discount_udf,
    "discount_report": q_discount_report,
    "revenue_by_product": q_revenue_by_product,
    "revenue_by_tier": q_revenue_by_tier,
    "revenue_by_tier_product": q_revenue_by_tier_product,
    "total_revenue": q_total_revenue,
    "max_order_per_customer": q_max_order_per_customer,
    "top_customers": q_top_customers,
    "summary_stats": q_summary_stats,
    "null_audit": q_null_audit,
    "word_count": q_word_count,
    "scan_parquet_count": q_scan_parquet_count,
    "view_session_count": q_view_session_count,
    "view_global_count": q_view_global_count,
    "sql_join_order": q_sql_join_order,
}

_CATEGORY = """CASE WHEN {v} IS NULL OR status IS NULL THEN 'UNKNOWN'
     WHEN status <> 'COMPLETED' THEN 'NON_COMPLETED'
     WHEN {v} >= 100000.0 THEN 'PREMIUM' WHEN {v} >= 50000.0 THEN 'HIGH'
     WHEN {v} >= 10000.0 THEN 'MEDIUM' ELSE 'LOW' END"""
_DISCOUNTED = """, ov AS (SELECT *, quantity * price AS order_value FROM orders_v3),
d1 AS (SELECT *, CASE WHEN order_value IS NULL THEN CAST(0.0 AS DOUBLE)
     WHEN promo_code IS NULL THEN order_value
     WHEN upper(promo_code) = 'SAVE10' THEN order_value * CAST(0.9 AS DOUBLE)
     WHEN upper(promo_code) = 'FLAT500' THEN greatest(CAST(0.0 AS DOUBLE), order_value - CAST(500.0 AS DOUBLE))
     WHEN upper(promo_code) = 'WELCOME200' THEN greatest(CAST(0.0 AS DOUBLE), order_value - CAST(200.0 AS DOUBLE))
     ELSE order_value END AS discounted_value FROM ov),
d AS (SELECT *, order_value - discounted_value AS discount_amount,
     """ + _CATEGORY.format(v="discounted_value") + """ AS category FROM d1)
"""
_DISCOUNT_SELECT = "SELECT * EXCLUDE (" + ", ".join(RULE_INPUTS) + ") FROM d"
_TIER_JOIN = "FROM orders_v2 o JOIN customers c ON o.customer_id = c.customer_id WHERE o.status = 'COMPLETED'"
_STATS = """SELECT '{c}' AS column_name, s.stat, s.value FROM (
  SELECT CAST(COUNT({c}) AS DOUBLE) AS n, AVG({c}) AS mean, STDDEV_SAMP({c}) AS dev,
         quantile_cont({c}, [0.25, 0.5, 0.75]) AS q,
         CAST(MIN({c}) AS DOUBLE) AS mn, CAST(MAX({c}) AS DOUBLE) AS mx
  FROM {t}) a,
LATERAL (VALUES ('count', a.n), ('mean', CAST(ROUND(CAST(a.mean AS DECIMAL(38,10)), 6) AS DOUBLE)),
                ('stddev', CAST(ROUND(CAST(a.dev AS DECIMAL(38,10)), 6) AS DOUBLE)),
                ('min', a.mn), ('p25', a.q[1]), ('p50', a.q[2]), ('p75', a.q[3]), ('max', a.mx)) s(stat, value)"""
_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM orders_dirty"
    for c in ["order_id", "customer_id", "product", "quantity", "price", "status", "order_date"]
)

ORACLE = {
    "filter_status": sql(["orders_v2"], "SELECT order_id, customer_id, product, quantity, price FROM orders_v2 WHERE status = 'COMPLETED'"),
    "order_value": sql(["orders_v2"], "SELECT order_id, product, quantity, price, quantity * price AS order_value FROM orders_v2"),
    "date_parse": """
SELECT order_id, date_text, CAST(try_strptime(date_text, '%d-%m-%Y') AS DATE) AS parsed_date FROM (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 50 = 0 THEN 'n/a'
              WHEN o_orderkey % 50 = 25 THEN '32-' || strftime(o_orderdate, '%m-%Y')
              ELSE strftime(o_orderdate, '%d-%m-%Y') END AS date_text
  FROM orders) t""",
    "category_case": sql(["orders_v3"], ", ov AS (SELECT *, quantity * price AS order_value FROM orders_v3)\n"
                         "SELECT order_id, order_value, status, " + _CATEGORY.format(v="order_value") + " AS category FROM ov"),
    "category_udf": sql(["orders_v3"], ", ov AS (SELECT *, quantity * price AS order_value FROM orders_v3)\n"
                        "SELECT order_id, order_value, status, " + _CATEGORY.format(v="order_value") + " AS category FROM ov"),
    "discount_builtin": sql(["orders_v3"], _DISCOUNTED + _DISCOUNT_SELECT),
    "discount_udf": sql(["orders_v3"], _DISCOUNTED + _DISCOUNT_SELECT),
    "discount_report": sql(["orders_v3"], _DISCOUNTED + """
SELECT product, promo_code, COUNT(order_id) AS order_count,
       CAST(ROUND(SUM(CAST(order_value AS DECIMAL(18,4))), 2) AS DOUBLE) AS gross_revenue,
       CAST(ROUND(SUM(CAST(discounted_value AS DECIMAL(18,4))), 2) AS DOUBLE) AS net_revenue,
       CAST(ROUND(SUM(CAST(discount_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS total_discount_given
FROM d WHERE status = 'COMPLETED' GROUP BY product, promo_code"""),
    "revenue_by_product": sql(["orders_v2"], f"""
SELECT product, COUNT(*) AS order_count, {msum('quantity * price')} AS total_revenue,
       {r2(mmean('quantity * price'))} AS avg_order_value
FROM orders_v2 WHERE status = 'COMPLETED' GROUP BY product"""),
    "revenue_by_tier": sql(["orders_v2", "customers"], f"""
SELECT c.tier, COUNT(*) AS order_count, {msum('o.quantity * o.price')} AS total_revenue,
       {r2(mmean('o.quantity * o.price'))} AS avg_order_value
{_TIER_JOIN} GROUP BY c.tier"""),
    "revenue_by_tier_product": sql(["orders_v2", "customers"], f"""
SELECT c.tier, o.product, COUNT(*) AS order_count, {msum('o.quantity * o.price')} AS total_revenue,
       {r2(mmean('o.quantity * o.price'))} AS avg_order_value
{_TIER_JOIN} GROUP BY c.tier, o.product"""),
    "total_revenue": sql(["orders_v2"], f"""
SELECT COUNT(*) AS order_count, {msum('quantity * price')} AS total_revenue,
       {r2(mmean('quantity * price'))} AS avg_order_value
FROM orders_v2 WHERE status = 'COMPLETED'"""),
    "max_order_per_customer": sql(["orders_v2", "customers"], """
SELECT o.customer_id, c.customer_name, MAX(o.quantity * o.price) AS max_order_value, COUNT(*) AS order_count
FROM orders_v2 o LEFT JOIN customers c ON o.customer_id = c.customer_id
WHERE o.status = 'COMPLETED' GROUP BY o.customer_id, c.customer_name"""),
    "top_customers": sql(["orders_v2"], f"""
SELECT customer_id, {msum('quantity * price')} AS total_spend
FROM orders_v2 WHERE status = 'COMPLETED' GROUP BY customer_id
ORDER BY total_spend DESC, customer_id ASC LIMIT 10"""),
    "summary_stats": "\nUNION ALL\n".join(
        _STATS.format(c=c, t=t) for c, t in (("o_totalprice", "orders"), ("l_quantity", "lineitem"))),
    "null_audit": sql(["orders_dirty"], _NULLS),
    "word_count": r"""
SELECT word, COUNT(*) AS n FROM (
  SELECT unnest(string_split_regex(trim(text), '[ \t\n\r\f\x0B]+')) AS word FROM documents) t
WHERE word <> '' GROUP BY word""",
    "scan_parquet_count": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in L.TABLES
    ),
    "view_session_count": "SELECT o_orderstatus, COUNT(*) AS row_count FROM orders GROUP BY o_orderstatus",
    "view_global_count": "SELECT o_orderstatus, COUNT(*) AS row_count FROM orders GROUP BY o_orderstatus",
    "sql_join_order": sql(["orders_v2", "customers"], """
SELECT o.order_id, c.customer_name, c.tier, o.product, o.quantity * o.price AS order_value
FROM orders_v2 o JOIN customers c ON o.customer_id = c.customer_id WHERE o.status = 'COMPLETED'"""),
}
