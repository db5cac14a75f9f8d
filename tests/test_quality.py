"""Data-quality rules on the reference's 12-row dirty-orders shape."""

from pyspark.sql import functions as F

from tablecraft.operators.aggregates import duplicate_keys, null_audit
from tablecraft.operators.dedup import dedup_latest
from tablecraft.operators.joins import orphans
from tablecraft.operators.quality import dq_overview, duplicate_flag, order_rules, split_quality, tag_rows

DIRTY = [
    (1, 1, "Laptop", 1, 75000.0, "COMPLETED", "2024-01-10"),
    (1, 1, "Laptop", 1, 75000.0, "COMPLETED", "2024-01-12"),
    (2, None, "Mouse", 2, 500.0, "PENDING", "2024-01-11"),
    (3, 2, None, 1, 1200.0, "COMPLETED", "2024-01-11"),
    (4, 3, "Monitor", 1, None, "CANCELLED", "2024-01-12"),
    (5, 999, "Keyboard", 1, 2500.0, "COMPLETED", "2024-01-13"),
    (6, 2, "Desk", -1, 9000.0, "COMPLETED", "2024-01-13"),
    (7, 3, "Chair", 2, 4000.0, None, "2024-01-14"),
    (8, 1, "Lamp", 1, 800.0, "SHIPPED", "2024-01-14"),
    (9, 2, "Pen", 10, 20.0, "PENDING", "2024-01-15"),
    (10, 3, "Phone", 1, 30000.0, "COMPLETED", "2024-01-15"),
    (11, 1, "Tablet", 1, 25000.0, "COMPLETED", None),
]
SCHEMA = "order_id int, customer_id int, product string, quantity int, price double, status string, order_date string"


def dirty(spark):
    return spark.createDataFrame(DIRTY, SCHEMA).withColumn("order_date", F.to_date("order_date"))


def customers(spark):
    return spark.createDataFrame([(1, "Ravi"), (2, "Asha"), (3, "Mei")], "customer_id int, customer_name string")


def test_split_is_a_partition(spark):
    df = dirty(spark)
    good, bad = split_quality(df, order_rules())
    assert good.count() + bad.count() == df.count() == 12


def test_negative_quantity_and_null_status_are_bad(spark):
    _, bad = split_quality(dirty(spark), order_rules())
    ids = {r.order_id for r in bad.collect()}
    assert 6 in ids  # negative quantity (defect D1 of the reference)
    assert 7 in ids  # null status (defect D2)
    assert {2, 3, 4, 8} <= ids


def test_tags_and_duplicates(spark):
    tagged = tag_rows(duplicate_flag(dirty(spark), "order_id"), order_rules())
    rows = {(r.order_id, r.order_date): r for r in tagged.collect()}
    assert sum(1 for r in rows.values() if r.is_duplicate) == 2
    assert duplicate_keys(dirty(spark), "order_id").collect()[0].order_id == 1


def test_null_audit_long_form(spark):
    audit = dict(null_audit(dirty(spark)).collect())
    assert audit["customer_id"] == 1 and audit["product"] == 1 and audit["price"] == 1
    assert audit["order_id"] == 0


def test_orphans(spark):
    ids = {r.customer_id for r in orphans(dirty(spark), customers(spark), "customer_id").collect()}
    assert 999 in ids


def test_clean_and_overview(spark):
    df = dirty(spark)
    good, _ = split_quality(df, order_rules())
    clean = dedup_latest(good, ["order_id"], ["order_date"])
    assert clean.count() == good.select("order_id").distinct().count()
    latest = clean.filter("order_id = 1").first()
    assert str(latest.order_date) == "2024-01-12"
    ov = dq_overview(df, order_rules(), "order_id").first()
    assert ov.total == 12 and ov.good + ov.bad == 12
    assert ov.duplicates_removed == good.count() - clean.count()


def test_summary_stats_agree_with_describe(spark, sf):
    from tablecraft.operators.aggregates import summary_stats

    o = spark.read.parquet(f"{sf}/orders.parquet")
    ours = {r.stat: r.value for r in summary_stats(o, ["o_totalprice"]).collect()}
    theirs = {r.summary: r.o_totalprice for r in o.select("o_totalprice").summary("count", "min", "max", "mean").collect()}
    assert ours["count"] == float(theirs["count"]) and ours["min"] == float(theirs["min"])
    assert ours["max"] == float(theirs["max"]) and abs(ours["mean"] - float(theirs["mean"])) < 1e-6
    assert ours["p25"] <= ours["p50"] <= ours["p75"]


def test_distributed_quantiles_equal_in_memory(spark, sf):
    from tablecraft.operators.aggregates import exact_quantiles

    probs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    o = spark.read.parquet(f"{sf}/orders.parquet")
    # a column with heavy duplicates and one hot value, besides a near-unique one
    dup = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id") % 41).alias("x"))
    for df, col in ((o, "o_totalprice"), (dup, "x")):
        narrowed = dict(exact_quantiles(df, col, probs).collect())
        memory = dict(exact_quantiles(df, col, probs, method="memory").collect())
        assert narrowed == memory


def _stats(df, *columns):
    from tablecraft.operators.aggregates import summary_stats

    return {(r.column_name, r.stat): r.value for r in summary_stats(df, list(columns)).collect()}


def test_statistics_keep_small_values_and_small_spreads(spark):
    df = spark.createDataFrame([(0.004, 1e9), (0.004, 1e9 + 0.01), (0.002, 1e9 + 0.02)], "a double, b double").repartition(3)
    s = _stats(df, "a", "b")
    assert abs(s["a", "mean"] - 0.01 / 3) < 1e-15 and abs(s["a", "stddev"] - 0.0011547005383792516) < 1e-12
    assert abs(s["b", "mean"] - (1e9 + 0.01)) < 1e-6 and abs(s["b", "stddev"] - 0.01) < 1e-6
    assert s["a", "p50"] == 0.004 and s["a", "p25"] == 0.003 and s["b", "max"] == 1e9 + 0.02


def test_statistics_of_odd_columns(spark):
    """Nulls, one row, no row, NaN and infinities, whole numbers."""
    df = spark.createDataFrame([(None, 5, None)] * 3 + [(1.5, 5, None)], "a double, b int, c double")
    s = _stats(df, "a", "b", "c")
    assert s["a", "count"] == 1 and s["a", "stddev"] is None and s["a", "p25"] == s["a", "p75"] == 1.5
    assert s["b", "p50"] == 5.0 and s["b", "stddev"] == 0.0
    assert s["c", "count"] == 0 and s["c", "mean"] is None and s["c", "p50"] is None
    assert _stats(df.limit(0), "a")["a", "count"] == 0
    odd = spark.createDataFrame([(x,) for x in (float("nan"), float("inf"), 1.0, -float("inf"), 2.0)], "a double")
    s = _stats(odd, "a")
    assert s["a", "p50"] == 2.0 and s["a", "min"] == -float("inf") and s["a", "max"] != s["a", "max"]


def test_quantiles_narrow_in_a_few_scans(spark, monkeypatch):
    """Far more distinct values than an approximate percentile tells apart."""
    from tablecraft.operators import aggregates as A

    monkeypatch.setattr(A, "_ACCURACY", 20)
    df = spark.range(20_000).select((F.xxhash64("id") % 100_003).cast("double").alias("x"))
    values = sorted(r.x for r in df.collect())
    s = _stats(df, "x")
    assert s["x", "p25"] == 0.25 * values[4999] + 0.75 * values[5000] or s["x", "p25"] == (1 - 0.75) * values[4999] + 0.75 * values[5000]
    assert s["x", "p50"] == (values[9999] + values[10_000]) / 2


def test_heavy_keys_are_found_by_sketch(spark):
    from tablecraft.operators.aggregates import heavy_hashes, heavy_keys, skew_report

    df = spark.range(60_000).select(
        F.when(F.col("id") % 10 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"), "id")
    df = df.repartition(7)
    want = [(r.k, r.n) for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n >= 600").orderBy(F.desc("n")).collect()]
    assert [tuple(r) for r in heavy_keys(df, ["k"], 0.01).collect()] == want and len(want) == 2
    assert {r.share for r in skew_report(df, ["k"], 0.05).collect()} == {0.1}
    assert heavy_hashes(df.limit(0), ["k"], 0.01) == (0, []) and heavy_keys(df.limit(0), ["k"], 0.01).collect() == []
    assert heavy_hashes(df, [], 0.5) == (60_000, [(0, 60_000)])
    two = df.withColumn("j", F.col("id") % 2)
    assert [tuple(r) for r in heavy_keys(two, ["k", "j"], 0.1).collect()] == [("hot", 0, 6000)]


def test_routing_computes_the_input_once(spark, tmp):
    from tablecraft.operators.quality import order_rules
    from tablecraft.plans import logical as L
    from tablecraft.sources.sinks import route

    raw = L.orders_dirty(spark, "/root/testdata/sf0.001")
    good, bad, counts = route(raw, order_rules(), f"{tmp}/routed")
    want_good, want_bad = split_quality(raw, order_rules())
    for got, want in ((good, want_good), (bad, want_bad)):
        assert got.columns == raw.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(verdict" in plan and plan.count("FileScan") == 1
    assert counts == {"raw": raw.count(), "good": good.count(), "bad": bad.count()}
    none, some, zero = route(raw.limit(0), order_rules(), f"{tmp}/empty")
    assert none.count() == some.count() == 0 and zero == {"raw": 0, "good": 0, "bad": 0}
