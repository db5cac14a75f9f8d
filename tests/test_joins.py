"""Join strategies give the same rows; plans use the requested strategy."""

from pyspark.sql import functions as F

from tablecraft.operators.joins import bounded_broadcast, hot_keys, join, salted_join
from tablecraft.plans import joins as J
from tablecraft.plans import logical as L


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_strategies_agree(spark, sf):
    base = J.q_join_inner(spark, sf).count()
    assert J.q_join_broadcast(spark, sf).count() == base
    assert J.q_join_merge_hint(spark, sf).count() == base
    assert J.q_join_broadcast_sql(spark, sf).count() == base
    assert J.q_join_left(spark, sf).count() >= base


def test_broadcast_and_merge_plans(spark, sf):
    o, c = L.orders_v2(spark, sf), L.customers(spark, sf)
    assert "BroadcastHashJoin" in plan(join(o, c, "customer_id", strategy="broadcast"))
    assert "SortMergeJoin" in plan(join(o, c, "customer_id", strategy="merge"))


def test_bounded_broadcast_falls_back(spark):
    df = spark.range(100)  # 800 bytes
    assert bounded_broadcast(df, max_bytes=1000) is not df
    assert bounded_broadcast(df, max_bytes=10) is df


def test_broadcast_decision_runs_no_job(spark, sf):
    before = max(spark.sparkContext.statusTracker().getJobIdsForGroup(None), default=-1)
    out = J.q_join_broadcast(spark, sf)
    assert max(spark.sparkContext.statusTracker().getJobIdsForGroup(None), default=-1) == before
    assert "SinglePartition" not in plan(out)


def test_salted_join_equals_plain_join(spark, sf):
    big = L.orders_skewed(spark, sf)
    small = L.customers(spark, sf).select("customer_id", "tier")
    plain = big.join(small, "customer_id").select("order_id", "tier")
    hot = hot_keys(big, ["customer_id"], 0.05)
    assert hot == [(1,)]
    for h in (hot, None):
        salted = salted_join(big, small, ["customer_id"], salts=4, hot=h).select("order_id", "tier")
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_salted_shuffle_plan_and_null_keys(spark, sf):
    big = L.orders_skewed(spark, sf).withColumn(
        "customer_id", F.when(F.col("order_id") % 10 == 0, F.lit(None).cast("long")).otherwise(F.col("customer_id")))
    small = L.customers(spark, sf).select("customer_id", "tier").hint("merge")
    hot = hot_keys(big, ["customer_id"], min_share=0.05)
    assert (1,) in hot
    out = salted_join(big, small, ["customer_id"], how="left", hot=hot)
    p = plan(out)
    assert "SortMergeJoin" in p and "_salt" in p[p.index("Exchange hashpartitioning"):]
    plain = big.join(small, "customer_id", "left").select(*out.columns)
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()


def test_key_skew_detects_hot_key(spark, sf):
    top = J.q_key_skew(spark, sf).orderBy(F.col("n").desc()).first()
    assert top.customer_id == 1 and top.ratio_to_avg > 3


def test_bucketed_join_has_no_exchange(spark, sf):
    df = J.q_bucketed_join(spark, sf, buckets=4)
    p = plan(df)
    assert "SortMergeJoin" in p or "BroadcastHashJoin" in p
    if "SortMergeJoin" in p:
        assert "Exchange hashpartitioning" not in p
    assert df.count() == spark.read.parquet(f"{sf}/orders.parquet").count()


def test_skew_join_plan(spark, sf):
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        # several map tasks, as a partition is split by the map outputs it is made of
        big = L.orders_skewed(spark, sf).repartition(8)
        small = L.customers(spark, sf).select("customer_id", "customer_name", "tier")
        df = join(big, small, "customer_id", "inner", "merge").select(*J.SKEW_COLS)
        assert len(df.collect()) == J.q_join_skew_aqe(spark, sf).count()
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final  # the hot partition was split
    finally:
        for k in ("skewedPartitionThresholdInBytes", "skewedPartitionFactor"):
            spark.conf.unset(f"spark.sql.adaptive.skewJoin.{k}")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_adaptive_plan_switches_to_broadcast(spark, sf):
    """No static broadcast; AQE sees the small customer side at runtime (10 MB)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    try:
        df = J.q_join_inner(spark, sf)
        static = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=false" in static and "SortMergeJoin" in static
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final and "BroadcastHashJoin" in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_salt_range_and_replication(spark):
    big = spark.createDataFrame([(1, i) for i in range(200)] + [(2, 0), (3, 0)], "k int, v int")
    small = spark.createDataFrame([(1, "hot"), (2, "x"), (3, "y")], "k int, name string")
    out = salted_join(big, small, ["k"], salts=3, hot=[(1,)])
    assert out.count() == big.count()
    # internals: hot rows spread over salts 0..2, the hot small row is replicated 3 times
    salted = big.withColumn("_s", F.pmod(F.xxhash64(*big.columns), F.lit(3)))
    assert {r._s for r in salted.filter("k = 1").select("_s").distinct().collect()} == {0, 1, 2}
    replicated = small.withColumn(
        "_salt", F.explode(F.when(F.col("k") == 1, F.sequence(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0))))
    )
    assert replicated.filter("k = 1").count() == 3 and replicated.filter("k <> 1").count() == 2


def test_bucketed_skew_join_spreads_the_hot_key(spark, sf, tmp):
    """No exchange in the join, and no file with the whole hot key."""
    from tablecraft.operators.joins import salted_sides
    from tablecraft.sources.sinks import write_bucketed

    df = J.q_bucketed_skew_join(spark, sf, buckets=4)
    want = J.q_join_salted(spark, sf)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert df.exceptAll(want).count() == 0 and want.exceptAll(df).count() == 0
    big = spark.createDataFrame([(1 if i % 2 else i, i) for i in range(4000)], "k int, i int")
    small = spark.createDataFrame([(i, str(i)) for i in range(4000)], "k int, name string")
    big_s, _ = salted_sides(big, small, ["k"], salts=8, hot=hot_keys(big, ["k"]), name="sub")
    table = write_bucketed(big_s, "tc_hot", 8, ["k", "sub"], path=f"{tmp}/hot")
    per_file = spark.table(table).where("k = 1").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) >= 4 and max(r["count"] for r in per_file) < 1500
    spark.sql(f"drop table {table}")
