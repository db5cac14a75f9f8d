"""Driver contract: entry runs, every query has a callable, and every query runs at sf0.001."""

import pytest

import __spark_entry__ as E
from tablecraft.plans import registry


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["tier", "order_count", "total_revenue", "avg_line_value", "revenue_rank"]
    assert df.count() == 5  # the five customer tiers of the smoke data


def test_oracle_keys_are_queries():
    assert set(registry.oracle_sql()) == set(registry.queries())  # every query has an SQL oracle
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(registry.queries()) <= set(E.queries())


def test_scratch_follows_checkpoint_dir(spark):
    from tablecraft.sources.scratch import scratch_path, scratch_root

    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    root = scratch_root(spark)
    if configured:
        assert root == configured.rstrip("/")
    assert scratch_path(spark, "x").startswith(root + "/tablecraft/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_runs(spark, sf, name):
    df = E.queries()[name](spark, sf)
    assert len(df.columns) == len(set(df.columns))
    df.write.format("noop").mode("overwrite").save()
