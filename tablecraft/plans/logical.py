"""Logical tables of the order domain, derived from the driver's TPC-style tables.

Each builder reads only the columns it needs (the Parquet scan prunes the rest) and
is a plain DataFrame plan; nothing is collected. Modulo rules on keys *inject* dirty
values deterministically (null ids, orphan ids, bad statuses); they never select or
drop rows. The same definitions exist as SQL text in :mod:`tablecraft.plans.sql_views`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.functions.columns import status_from_code
from tablecraft.operators.dedup import scd2_build
from tablecraft.operators.joins import bounded_broadcast
from tablecraft.operators.nested import nest_items

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


#: (session, sf_dir, table or builder) -> (state of the folder, DataFrame)
_READS: dict[tuple, tuple[tuple, DataFrame]] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of what is at ``sf_dir``: one listing."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    entries = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    return tuple(sorted((e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in entries))


def _memoized(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """``build()``, reused within a session while the files at ``sf_dir`` stay as they are."""
    key, state = (id(spark), sf_dir.rstrip("/"), name), _state(spark, sf_dir)
    held = _READS.get(key)
    if held is None or held[0] != state or held[1].sparkSession is not spark:
        held = _READS[key] = (state, build())
    return held[1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (read-only input). The DataFrame is reused within a session, so
    repeated queries skip re-listing the files and re-reading the Parquet footers."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return _memoized(spark, sf_dir, name, lambda: spark.read.parquet(path))


def clear_table_cache() -> None:
    """Forget memoized tables."""
    _READS.clear()


def per_session(builder):
    """Memoize a logical-table builder per (session, sf_dir): the result is an immutable
    plan over read-only inputs, so queries can share it instead of rebuilding it."""
    import functools

    @functools.wraps(builder)
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _memoized(spark, sf_dir, f"#{builder.__name__}", lambda: builder(spark, sf_dir))

    return wrapper


@per_session
def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x part, one row per line, with the raw keys kept."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(p, li.l_partkey == p.p_partkey)
        .select(
            "l_orderkey", "l_partkey", "l_suppkey",
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("p_type").alias("product"),
            F.col("l_quantity").cast("long").alias("quantity"),
            F.col("p_retailprice").alias("price"),
            status_from_code("o_orderstatus").alias("status"),
            F.to_date("o_orderdate").alias("order_date"),
        )
    )


V2_COLUMNS = ["order_id", "customer_id", "product", "quantity", "price", "status", "order_date"]


@per_session
def orders_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select(*V2_COLUMNS)


@per_session
def orders_v3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders_v2 plus a promo code (mixed case, unknown and null codes included)."""
    k = F.col("l_orderkey") % 5
    promo = (
        F.when(k == 0, "SAVE10").when(k == 1, "FLAT500").when(k == 2, "welcome200")
        .when(k == 3, "OTHER")
    )
    return order_lines(spark, sf_dir).select(*V2_COLUMNS, promo.alias("promo_code"))


@per_session
def orders_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders_v2 with injected faults: null/orphan customer, null product/price,
    negative quantity, null or unknown status."""
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    return order_lines(spark, sf_dir).select(
        "order_id",
        F.when(ok % 97 == 0, F.lit(None).cast("long")).when(ok % 89 == 0, F.lit(-1).cast("long"))
        .otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(pk % 83 == 0, F.lit(None).cast("string")).otherwise(F.col("product")).alias("product"),
        F.when(pk % 79 == 0, -F.col("quantity")).otherwise(F.col("quantity")).alias("quantity"),
        F.when(sk % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("price")).alias("price"),
        F.when(ok % 71 == 0, F.lit(None).cast("string")).when(ok % 73 == 0, F.lit("X"))
        .otherwise(F.col("status")).alias("status"),
        "order_date",
    )


@per_session
def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x nation: (customer_id, customer_name, city, tier)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a small code table; broadcast only within the byte limit
    return c.join(bounded_broadcast(n), c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("tier"),
    )


@per_session
def orders_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows keyed by (order_id, line_no), versioned by ``updated_at``."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("line_no"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extended_price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.to_date("l_shipdate").alias("updated_at"),
    )


@per_session
def customers_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-2 customer dimension: the tier (order priority) a customer had from each
    order date on; one version per (customer, date), the highest order key wins."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    per_day = (
        o.groupBy(F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("changed_on"))
        .agg(F.max(F.struct("o_orderkey", "o_orderpriority")).alias("_v"))
        .select("customer_id", "changed_on", F.col("_v.o_orderpriority").alias("tier"))
    )
    return scd2_build(per_day, ["customer_id"], "changed_on").select(
        "customer_id", "tier", "effective_from", "effective_to", "is_current"
    )


@per_session
def temporal_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line events: (order_id, line_no, customer_id, event_date = ship date)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("line_no"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("l_shipdate").alias("event_date"),
    )


def payment_status(priority: str = "o_orderpriority"):
    """Payments of low-priority orders failed, whatever became of the order."""
    return F.when(F.col(priority) == "5-LOW", F.lit("FAILED")).otherwise(F.lit("SUCCESS"))


@per_session
def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested order documents: customer and payment structs, items array.

    Orders without lines keep a null ``items`` array.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    lines = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey",
        F.col("p_type").alias("product"),
        F.col("p_retailprice").alias("price"),
        F.col("l_quantity").cast("long").alias("quantity"),
    )
    items = nest_items(lines, ["l_orderkey"], ["price", "product", "quantity"])
    cust = customers(spark, sf_dir)
    return (
        o.join(items, o.o_orderkey == items.l_orderkey, "left")
        .join(cust, o.o_custkey == cust.customer_id, "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("event_timestamp"),
            F.struct(
                F.col("customer_id").alias("id"),
                F.col("customer_name").alias("name"),
                F.col("tier"),
                F.col("city"),
            ).alias("customer"),
            F.struct(
                F.col("o_orderpriority").alias("method"),
                payment_status().alias("status"),
                F.col("o_totalprice").alias("amount"),
            ).alias("payment"),
            "items",
        )
    )


@per_session
def payment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment documents already flat: one row per order line, orders without
    lines once with null item fields. Same rows as ``explode_outer`` over
    :func:`transactions`, but no order's lines are ever gathered into one row."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    lines = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey",
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("product"),
        F.col("l_quantity").cast("long").alias("quantity"),
    )
    paid = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("payment_method"),
        payment_status().alias("payment_status"),
    )
    lines = lines.withColumn("line_value", F.col("price") * F.col("quantity")).withColumnRenamed("l_orderkey", "order_id")
    return paid.join(lines, "order_id", "left").join(customers(spark, sf_dir), "customer_id", "left")


URGENT = "1-URGENT"  # order priority whose orders arrive in two versions


def channel(key: str = "o_orderkey"):
    k = F.col(key) % 3
    return F.when(k == 0, "WEB").when(k == 1, "APP").otherwise("STORE")


@per_session
def orders_dirty_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline input: every order as CSV-like text rows with injected faults, plus an
    earlier PENDING version (one day before) of every urgent order, so keep-latest
    matters. ``order_date`` is text ``dd-MM-yyyy``."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    k = F.col("o_orderkey")
    base = o.select(
        k.alias("order_id"),
        F.when(k % 89 == 0, F.lit(None).cast("long")).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderpriority").alias("product_category"),
        F.when(k % 97 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("total_amount"),
        F.when(k % 71 == 0, F.lit(None).cast("string")).when(k % 73 == 0, F.lit("X"))
        .otherwise(status_from_code("o_orderstatus")).alias("status"),
        F.to_date("o_orderdate").alias("_d"),
        channel().alias("channel"),
    )
    # the versions of an order come from one row, so the orders are read once
    now = F.struct("status", "_d")
    before = F.struct(F.lit("PENDING").alias("status"), F.date_sub("_d", 1).alias("_d"))
    versions = F.when(F.col("product_category") == URGENT, F.array(now, before)).otherwise(F.array(now))
    return base.withColumn("_v", F.explode(versions)).select(
        "order_id", "customer_id", "product_category", "total_amount", "_v.status",
        F.date_format("_v._d", "dd-MM-yyyy").alias("order_date"), "channel",
    )


@per_session
def orders_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders whose customer key 1 holds two thirds of the rows (a hot key)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 3 < 2, F.lit(1).cast("long")).otherwise(F.col("o_custkey")).alias("customer_id"),
        status_from_code("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
    )


@per_session
def orders_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with a unique key, used for per-customer windows."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
        status_from_code("o_orderstatus").alias("status"),
    )
