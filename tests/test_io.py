"""Readers and sinks: permissive CSV, partition pruning, verified writes, catalog."""

from pyspark.sql import functions as F

from tablecraft.plans import io as IO
from tablecraft.sources.readers import read_csv_permissive
from tablecraft.sources.sinks import write_verified


def test_permissive_csv_keeps_bad_rows(spark, tmp):
    path = f"{tmp}/o.csv"
    with open(path, "w") as f:
        f.write("order_id,customer_id,status,total_price,order_date\n1,1,F,10.5,2024-01-01\n2,2,O,abc,2024-01-02\n")
    df = read_csv_permissive(spark, path, IO.ORDER_SCHEMA, corrupt_column="_bad")
    rows = {r.order_id: r for r in df.collect()}
    assert len(rows) == 2 and rows[2].total_price is None and rows[2]._bad is not None
    assert rows[1].total_price == 10.5 and rows[1]._bad is None


def test_partition_pruning_in_plan(spark, sf):
    df = IO.q_partition_pruned_scan(spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan and "= O)" in plan
    assert df.filter("o_orderstatus <> 'O'").count() == 0


def test_write_verified(spark, tmp):
    assert write_verified(spark.range(1234), f"{tmp}/v") == 1234


def test_catalog_external_table(spark, sf):
    n = IO.q_catalog_external_table(spark, sf).agg(F.sum("n")).first()[0]
    assert n == spark.read.parquet(f"{sf}/customer.parquet").count()


def test_layouts(spark, sf):
    from tablecraft.operators.layout import by_key, cached, round_robin, shrink

    o = spark.read.parquet(f"{sf}/orders.parquet")
    assert round_robin(o, 10).rdd.getNumPartitions() == 10
    assert by_key(o, 9, "o_orderstatus").rdd.getNumPartitions() == 9
    one = o.coalesce(1)
    assert shrink(one, 6).rdd.getNumPartitions() == 1  # coalesce never grows
    with cached(o) as c:
        assert c.is_cached and c.count() == o.count()
    assert not o.is_cached


def test_scale_settings():
    from tablecraft.config import scale_settings

    small = scale_settings(40 * 2**20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = scale_settings(100 * 10**12, 8000)  # 100 TB on 1000 executors x 8 cores
    n = int(big["spark.sql.shuffle.partitions"])
    assert n % 8000 == 0 and 100 * 10**12 / n <= 2 * 256 * 2**20
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scale_settings_do_not_switch_with_size():
    from tablecraft.config import MB, scale_settings

    small, large = scale_settings(40 * MB, 8), scale_settings(100 * 2**40, 8000)
    assert set(small) == set(large)
    key = "spark.sql.streaming.stateStore.providerClass"
    assert small[key] == large[key] and "RocksDB" in small[key]
    assert int(large["spark.sql.shuffle.partitions"]) * 256 * MB >= 100 * 2**40


def test_a_changed_table_is_read_anew(spark, sf, tmp):
    from tablecraft.plans import logical as L

    for t in ("orders", "customer", "nation"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{tmp}/d/{t}.parquet")
    first, people = L.orders_flat(spark, f"{tmp}/d"), L.customers(spark, f"{tmp}/d")
    assert L.orders_flat(spark, f"{tmp}/d") is first and L.customers(spark, f"{tmp}/d/") is people
    n = first.count()
    spark.read.parquet(f"{sf}/orders.parquet").limit(3).write.mode("append").parquet(f"{tmp}/d/orders.parquet")
    assert L.orders_flat(spark, f"{tmp}/d").count() == n + 3
