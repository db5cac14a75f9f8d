"""Order/payment job invariants at sf0.001: stage counts, keep-latest, reports."""

from pyspark.sql import functions as F

from tablecraft.operators.quality import split_quality
from tablecraft.plans import e2e
from tablecraft.plans import logical as L


def test_stage_counts(spark, sf):
    raw = L.orders_dirty_v2(spark, sf)
    good, bad = split_quality(raw, e2e.payment_rules())
    total = raw.count()
    assert good.count() + bad.count() == total
    assert bad.count() > 0  # injected faults are caught
    corr = e2e.correlated(spark, sf)
    # keep-latest: one surviving order row per order id, joined to its payment lines
    per_order = corr.groupBy("order_id").agg(F.countDistinct("order_date").alias("d"))
    assert per_order.filter("d > 1").count() == 0


def test_reports(spark, sf):
    corr = e2e.correlated(spark, sf)
    tiers = e2e.revenue_by_tier(corr).collect()
    ranks = sorted(r.revenue_rank for r in tiers)
    assert ranks[0] == 1 and len(tiers) == len({r.tier for r in tiers})
    by_rank = sorted(tiers, key=lambda r: r.revenue_rank)
    assert all(a.total_revenue >= b.total_revenue for a, b in zip(by_rank, by_rank[1:]))
    top = e2e.top_product_per_tier(corr)
    assert top.select("tier").distinct().count() == len(tiers)
    ch = e2e.revenue_by_channel(corr)
    assert abs(sum(r.total_revenue for r in ch.collect()) - sum(r.total_revenue for r in tiers)) < 1e-6


def test_running_revenue_is_monotone(spark, sf):
    rr = e2e.running_revenue(e2e.correlated(spark, sf))
    # line values are non-negative, so each customer's running revenue never decreases
    assert rr.filter(F.col("line_value") < 0).count() == 0
    final = rr.groupBy("customer_name").agg(F.max("running_revenue").alias("m"), F.sum("line_value").alias("s"))
    assert final.filter(F.abs(F.col("m") - F.col("s")) > 1e-6).count() == 0


def test_flat_lines_equal_flattened_documents(spark, sf):
    flat = e2e.correlated(spark, sf)
    nested = e2e.correlated(spark, sf, nested=True).select(*flat.columns)
    assert flat.count() == nested.count()
    assert flat.exceptAll(nested).count() == 0 and nested.exceptAll(flat).count() == 0


def test_job_with_sinks(spark, sf, tmp):
    out = e2e.run_order_payment_job(spark, sf, tmp, processing_day="2024-01-15")
    c = out["counts"]
    assert c["good"] + c["bad"] == c["raw"] and c["kept"] <= c["good"]
    q = spark.read.parquet(out["paths"]["quarantine"])
    assert q.count() == c["bad"] and {str(r.quarantine_date) for r in q.select("quarantine_date").distinct().collect()} == {"2024-01-15"}
    report = {r.tier: r.total_revenue for r in spark.read.parquet(out["paths"]["report"]).collect()}
    expected = {r.tier: r.total_revenue for r in e2e.revenue_by_tier(e2e.correlated(spark, sf)).collect()}
    assert report == expected
    corr = spark.read.parquet(out["paths"]["correlated"])
    assert corr.count() == e2e.correlated(spark, sf).count()
