"""Merge-style table changes over plain Parquet: append, upsert, delete, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from tablecraft.operators import versions as V
from tablecraft.sources.sinks import write_parquet

V1 = [(i, "PENDING", 100.0 * i) for i in range(1, 6)]
V2 = [(1, "COMPLETED", 100.0), (6, "PENDING", 600.0), (7, "PENDING", 700.0)]
SCHEMA = "order_id int, status string, amount double"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_updates_and_inserts(spark):
    merged = V.upsert(spark.createDataFrame(V1, SCHEMA), spark.createDataFrame(V2, SCHEMA), ["order_id"])
    assert rows(merged) == sorted(V1[1:] + V2)
    assert merged.columns == ["order_id", "status", "amount"]


def test_repeated_new_keys_are_all_inserted(spark):
    t = spark.createDataFrame(V1, SCHEMA)
    s = spark.createDataFrame([(9, "A", 1.0), (9, "B", 2.0), (1, "DONE", 3.0)], SCHEMA)
    assert rows(V.upsert(t, s, ["order_id"])) == sorted(V1[1:] + [(9, "A", 1.0), (9, "B", 2.0), (1, "DONE", 3.0)])


def test_ambiguous_update_raises(spark):
    t = spark.createDataFrame(V1, SCHEMA)
    s = spark.createDataFrame([(1, "A", 1.0), (1, "B", 2.0)], SCHEMA)
    with pytest.raises(Exception, match="several source rows match"):
        V.upsert(t, s, ["order_id"]).collect()


def test_null_keys_match_nothing(spark):
    t = spark.createDataFrame([(None, "old", 1.0), (1, "old", 1.0)], SCHEMA)
    s = spark.createDataFrame([(None, "new", 2.0), (None, "newer", 2.0), (1, "new", 2.0)], SCHEMA)
    out = V.upsert(t, s, ["order_id"]).groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.order_id: r.n for r in out} == {None: 3, 1: 1}


def test_delete_keeps_null_condition_rows(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, "CANCELLED", 2.0)], SCHEMA)
    assert [r.order_id for r in V.delete_where(df, F.col("status") == "CANCELLED").collect()] == [1]


def test_plain_append_and_compaction(spark, tmp):
    path = write_parquet(spark.createDataFrame(V1, SCHEMA).repartition(5), f"{tmp}/t")
    for _ in range(3):
        write_parquet(spark.createDataFrame(V2, SCHEMA), path, mode="append")
    out = write_parquet(V.compacted(spark, path), f"{tmp}/compact")
    assert rows(spark.read.parquet(out)) == sorted(V1 + 3 * V2)
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) == 1
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet"))
    many = write_parquet(V.compacted(spark, path, file_bytes=size // 4), f"{tmp}/many")
    assert len([f for f in os.listdir(many) if f.endswith(".parquet")]) >= 4
