"""Source / sink round trips, catalog registration and physical-layout queries.

Each query writes under a fresh folder of the shared scratch root and returns what
it reads back from storage, so the check covers the real file content.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from tablecraft.operators.layout import by_key, cached, round_robin, shrink
from tablecraft.plans import logical as L
from tablecraft.plans.sql_views import STATUS_CASE, sql
from tablecraft.sources.catalog import create_database, describe, drop_table, list_tables, register_external_parquet
from tablecraft.sources.readers import read_csv, read_csv_permissive, read_parquet
from tablecraft.sources.scratch import scratch_path
from tablecraft.sources.sinks import write_csv, write_parquet, write_verified

ORDER_SCHEMA = StructType([
    StructField("order_id", LongType()),
    StructField("customer_id", LongType()),
    StructField("status", StringType()),
    StructField("total_price", DoubleType()),
    StructField("order_date", DateType()),
])
ORDER_COLS = [f.name for f in ORDER_SCHEMA.fields]


def _orders_text(spark, sf, bad_price: bool = False):
    o = L.table(spark, sf, "orders")
    price = F.col("o_totalprice").cast("string")
    if bad_price:  # malformed cell injected for the permissive reader
        price = F.when(F.col("o_orderkey") % 50 == 0, F.lit("abc")).otherwise(price)
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        price.alias("total_price"),
        F.to_date("o_orderdate").alias("order_date"),
    )


def q_scan_csv_infer(spark, sf):
    """CSV with header, types inferred; widened to stable types for the result."""
    path = write_csv(_orders_text(spark, sf), scratch_path(spark, "orders_csv"))
    df = read_csv(spark, path, options={"header": "true", "inferSchema": "true", "sep": ","})
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ORDER_SCHEMA.fields])


def q_scan_csv_schema(spark, sf):
    path = write_csv(_orders_text(spark, sf), scratch_path(spark, "orders_csv"))
    return read_csv(spark, path, schema=ORDER_SCHEMA)


def q_scan_csv_permissive(spark, sf):
    """A malformed price becomes null, the row is kept, its raw line is preserved."""
    path = write_csv(_orders_text(spark, sf, bad_price=True), scratch_path(spark, "orders_csv_bad"))
    df = read_csv_permissive(spark, path, ORDER_SCHEMA, corrupt_column="_corrupt")
    return df.select(*ORDER_COLS, F.col("_corrupt").isNotNull().alias("is_malformed"))


def q_partition_pruned_scan(spark, sf, status: str = "O"):
    """Hive-partitioned write; the status filter prunes directories at planning time."""
    o = L.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    path = write_parquet(o, scratch_path(spark, "orders_by_status"), partition_by=["o_orderstatus"])
    return read_parquet(spark, path).filter(F.col("o_orderstatus") == status).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"
    )


def q_write_read_roundtrip(spark, sf):
    """Enriched orders written with row-count verification, then read back."""
    o = L.orders_v2(spark, sf).join(L.customers(spark, sf), "customer_id")
    enriched = o.withColumn("order_value", F.col("quantity") * F.col("price"))
    path = scratch_path(spark, "enriched_orders")
    write_verified(enriched, path)
    back = read_parquet(spark, path)
    return back.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("order_value").cast("decimal(18,2)")).cast("double").alias("total_value"),
    )


def q_catalog_external_table(spark, sf):
    """Partitioned files registered as an external table; partitions recovered by repair."""
    c = L.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = write_parquet(c, scratch_path(spark, "customer_by_segment"), partition_by=["c_mktsegment"])
    db = f"tablecraft_{uuid.uuid4().hex[:8]}"
    create_database(spark, db, scratch_path(spark, db))
    table = register_external_parquet(
        spark, db, "customers", "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING",
        path, ["c_mktsegment"],
    )
    return spark.sql(f"SELECT c_mktsegment AS segment, COUNT(*) AS n FROM {table} GROUP BY c_mktsegment")


def q_repartition_rowcount(spark, sf):
    """Row counts are unchanged by round-robin, hash and coalesce layouts."""
    o = L.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    layouts = {
        "round_robin_10": round_robin(o, 10),
        "hash_status_9": by_key(o, 9, "o_orderstatus"),
        "coalesce_6": shrink(o, 6),
    }
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(k).alias("strategy"), "row_count")
             for k, df in layouts.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_cached_reuse(spark, sf):
    """A filtered input cached once and used by two actions: a count, and a report that is
    written while the cache is held."""
    done = L.orders_flat(spark, sf).filter(F.col("status") == "COMPLETED")
    with cached(done) as d:
        total = d.count()
        path = write_parquet(share_report(d, total), scratch_path(spark, "cached_report"))
    return read_parquet(spark, path)


def q_persisted_levels(spark, sf):
    """One input kept on disk only, then in memory with spill, and summed from both."""
    lines = L.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    out = None
    for name in ("DISK_ONLY", "MEMORY_AND_DISK"):
        with cached(lines, getattr(StorageLevel, name)) as kept:
            row = kept.agg(F.count(F.lit(1)), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double")).first()
        one = spark.createDataFrame([(name, *row)], "level string, n long, quantity double")
        out = one if out is None else out.unionByName(one)
    return out


def q_catalog_life_cycle(spark, sf):
    """Columns of an external table as the catalog describes them, after which the table is
    dropped; whether it was listed before and after, and whether its files are still there."""
    c = L.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = write_parquet(c, scratch_path(spark, "customer_life"), partition_by=["c_mktsegment"])
    db = f"tablecraft_{uuid.uuid4().hex[:8]}"
    create_database(spark, db, scratch_path(spark, db))
    table = register_external_parquet(
        spark, db, "customers", "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING",
        path, ["c_mktsegment"])
    columns = [(r.col_name, r.data_type) for r in describe(spark, table).collect() if r.data_type and not r.col_name.startswith("#")]
    listed = "customers" in list_tables(spark, db)
    drop_table(spark, table)
    gone = "customers" not in list_tables(spark, db)
    kept = read_parquet(spark, path).count()
    rows = [(*x, listed, gone) for x in dict.fromkeys(columns)]
    return spark.createDataFrame(rows, "column_name string, kind string, listed boolean, dropped boolean").withColumn("rows_on_storage", F.lit(kept))


def share_report(orders, total):
    """Orders per customer and their share of ``total``."""
    per_customer = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return per_customer.withColumn("share", F.col("n") / F.lit(float(total)))


QUERIES = {
    "scan_csv_infer": q_scan_csv_infer,
    "scan_csv_schema": q_scan_csv_schema,
    "scan_csv_permissive": q_scan_csv_permissive,
    "partition_pruned_scan": q_partition_pruned_scan,
    "write_read_roundtrip": q_write_read_roundtrip,
    "catalog_external_table": q_catalog_external_table,
    "repartition_rowcount": q_repartition_rowcount,
    "cached_reuse": q_cached_reuse,
    "persisted_levels": q_persisted_levels,
    "catalog_life_cycle": q_catalog_life_cycle,
}

_ORDERS_CSV = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_totalprice AS total_price, CAST(o_orderdate AS DATE) AS order_date FROM orders"""

ORACLE = {
    "scan_csv_infer": _ORDERS_CSV,
    "scan_csv_schema": _ORDERS_CSV,
    "scan_csv_permissive": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_totalprice END AS total_price,
       CAST(o_orderdate AS DATE) AS order_date, o_orderkey % 50 = 0 AS is_malformed FROM orders""",
    "partition_pruned_scan": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'O'""",
    "write_read_roundtrip": sql(["orders_v2", "customers"], """
SELECT COUNT(*) AS row_count, CAST(SUM(CAST(o.quantity * o.price AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM orders_v2 o JOIN customers c ON o.customer_id = c.customer_id"""),
    "catalog_external_table": "SELECT c_mktsegment AS segment, COUNT(*) AS n FROM customer GROUP BY c_mktsegment",
    "persisted_levels": """
SELECT l.level, (SELECT COUNT(*) FROM lineitem) AS n,
       (SELECT CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem) AS quantity
FROM (VALUES ('DISK_ONLY'), ('MEMORY_AND_DISK')) l(level)""",
    "catalog_life_cycle": """
SELECT c.column_name, c.kind, true AS listed, true AS dropped, (SELECT COUNT(*) FROM customer) AS rows_on_storage
FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_acctbal', 'double'), ('c_mktsegment', 'string')) c(column_name, kind)""",
    "repartition_rowcount": """
SELECT s.strategy, (SELECT COUNT(*) FROM orders) AS row_count
FROM (VALUES ('round_robin_10'), ('hash_status_9'), ('coalesce_6')) s(strategy)""",
    "cached_reuse": f"""
SELECT o_custkey AS customer_id, COUNT(*) AS n,
       COUNT(*) / CAST((SELECT COUNT(*) FROM orders WHERE {STATUS_CASE.format(c='o_orderstatus')} = 'COMPLETED') AS DOUBLE) AS share
FROM orders WHERE {STATUS_CASE.format(c='o_orderstatus')} = 'COMPLETED' GROUP BY o_custkey""",
}
