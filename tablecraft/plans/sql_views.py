"""The logical tables of :mod:`tablecraft.plans.logical` as ANSI SQL (DuckDB dialect).

Used only by the correctness oracle: each registered query has an independent SQL
formulation over the raw driver tables. ``with_views("a", "b")`` returns a WITH
clause holding those views and everything they depend on.
"""

from __future__ import annotations

STATUS_CASE = (
    "CASE {c} WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'CANCELLED' END"
)

_VIEWS: dict[str, tuple[list[str], str]] = {
    "order_lines": ([], f"""
    SELECT l.l_orderkey, l.l_partkey, l.l_suppkey,
           CAST(l.l_orderkey * 10 + l.l_linenumber AS BIGINT) AS order_id,
           o.o_custkey AS customer_id, p.p_type AS product,
           CAST(l.l_quantity AS BIGINT) AS quantity, p.p_retailprice AS price,
           {STATUS_CASE.format(c='o.o_orderstatus')} AS status,
           CAST(o.o_orderdate AS DATE) AS order_date
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                    JOIN part p ON l.l_partkey = p.p_partkey"""),
    "orders_v2": (["order_lines"], """
    SELECT order_id, customer_id, product, quantity, price, status, order_date FROM order_lines"""),
    "orders_v3": (["order_lines"], """
    SELECT order_id, customer_id, product, quantity, price, status, order_date,
           CASE l_orderkey % 5 WHEN 0 THEN 'SAVE10' WHEN 1 THEN 'FLAT500'
                WHEN 2 THEN 'welcome200' WHEN 3 THEN 'OTHER' END AS promo_code
    FROM order_lines"""),
    "orders_dirty": (["order_lines"], """
    SELECT order_id,
           CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN CAST(-1 AS BIGINT)
                ELSE customer_id END AS customer_id,
           CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE product END AS product,
           CASE WHEN l_partkey % 79 = 0 THEN -quantity ELSE quantity END AS quantity,
           CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE price END AS price,
           CASE WHEN l_orderkey % 71 = 0 THEN NULL WHEN l_orderkey % 73 = 0 THEN 'X'
                ELSE status END AS status,
           order_date
    FROM order_lines"""),
    "customers": ([], """
    SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, n.n_name AS city,
           c.c_mktsegment AS tier
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    "orders_dupes": ([], """
    SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no,
           l_partkey AS part_id, l_suppkey AS supplier_id, l_quantity AS quantity,
           l_extendedprice AS extended_price, l_discount AS discount, l_tax AS tax,
           l_returnflag AS return_flag, l_linestatus AS line_status,
           CAST(l_shipdate AS DATE) AS updated_at
    FROM lineitem"""),
    "scd_changes": ([], """
    SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS changed_on,
           arg_max(o_orderpriority, o_orderkey) AS tier
    FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)"""),
    "customers_scd2": (["scd_changes"], """
    SELECT customer_id, tier, changed_on AS effective_from,
           CAST(LEAD(changed_on) OVER (PARTITION BY customer_id ORDER BY changed_on)
                - INTERVAL 1 DAY AS DATE) AS effective_to,
           LEAD(changed_on) OVER (PARTITION BY customer_id ORDER BY changed_on) IS NULL
               AS is_current
    FROM scd_changes"""),
    "temporal_facts": ([], """
    SELECT l.l_orderkey AS order_id, CAST(l.l_linenumber AS BIGINT) AS line_no,
           o.o_custkey AS customer_id, CAST(l.l_shipdate AS DATE) AS event_date
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    # nested transactions, already flattened: one row per item; orders without lines
    # appear once with null item fields (explode_outer)
    "txn_items": (["customers"], """
    SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
           o.o_orderdate AS event_timestamp,
           c.customer_name, c.tier, c.city,
           o.o_orderpriority AS payment_method,
           CASE WHEN o.o_orderpriority = '5-LOW' THEN 'FAILED' ELSE 'SUCCESS' END AS payment_status,
           o.o_totalprice AS amount,
           it.price, it.product, it.quantity
    FROM orders o
    LEFT JOIN (SELECT l.l_orderkey, p.p_type AS product, p.p_retailprice AS price,
                      CAST(l.l_quantity AS BIGINT) AS quantity
               FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) it
           ON it.l_orderkey = o.o_orderkey
    LEFT JOIN customers c ON c.customer_id = o.o_custkey"""),
    "orders_dirty_v2_base": ([], f"""
    SELECT o_orderkey AS order_id,
           CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_custkey END AS customer_id,
           o_orderpriority AS product_category,
           CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS total_amount,
           CASE WHEN o_orderkey % 71 = 0 THEN NULL WHEN o_orderkey % 73 = 0 THEN 'X'
                ELSE {STATUS_CASE.format(c='o_orderstatus')} END AS status,
           CAST(o_orderdate AS DATE) AS d,
           CASE o_orderkey % 3 WHEN 0 THEN 'WEB' WHEN 1 THEN 'APP' ELSE 'STORE' END AS channel
    FROM orders"""),
    "orders_dirty_v2": (["orders_dirty_v2_base"], """
    SELECT order_id, customer_id, product_category, total_amount, status,
           strftime(d, '%d-%m-%Y') AS order_date, channel
    FROM (SELECT * FROM orders_dirty_v2_base
          UNION ALL
          SELECT order_id, customer_id, product_category, total_amount, 'PENDING' AS status,
                 CAST(d - INTERVAL 1 DAY AS DATE) AS d, channel
          FROM orders_dirty_v2_base WHERE product_category = '1-URGENT') u"""),
    "orders_skewed": ([], f"""
    SELECT o_orderkey AS order_id,
           CASE WHEN o_orderkey % 3 < 2 THEN CAST(1 AS BIGINT) ELSE o_custkey END AS customer_id,
           {STATUS_CASE.format(c='o_orderstatus')} AS status, o_totalprice AS amount
    FROM orders"""),
    "orders_flat": ([], f"""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
           CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS amount,
           {STATUS_CASE.format(c='o_orderstatus')} AS status
    FROM orders"""),
}


def with_views(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for ``names`` and their dependencies."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        for dep in _VIEWS[n][0]:
            visit(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({_VIEWS[n][1]}\n)" for n in ordered) + "\n"


def sql(views: list[str] | tuple[str, ...], body: str) -> str:
    return with_views(*views) + body if views else body


def msum(x: str) -> str:
    """Exact money sum (matches ``money_sum``)."""
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mmean(x: str) -> str:
    """Exact-sum mean (matches ``money_mean``)."""
    return f"(CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({x}))"


def round2(x: str) -> str:
    """Half-up cents rounding (matches ``round2``)."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), 2) AS DOUBLE)"
