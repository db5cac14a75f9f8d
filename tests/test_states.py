"""Tables kept as numbered folders: create or merge, failed writes, earlier states."""

import os

import pytest
from pyspark.sql import functions as F

from tablecraft.sources import states as S

SCHEMA = "order_id int, status string, amount double"
V1 = [(i, "PENDING", 100.0 * i) for i in range(1, 6)]
V2 = [(1, "COMPLETED", 100.0), (6, "PENDING", 600.0)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("partition_by", [None, ["status"]])
def test_absent_empty_and_present_targets(spark, tmp, partition_by):
    """The table is made where it is absent, and merged into where it is empty or has rows."""
    path, columns = f"{tmp}/t", ["order_id", "status", "amount"]
    assert S.committed(spark, path) == {} and not S.exists(spark, path)
    with pytest.raises(FileNotFoundError):
        S.read_latest(spark, path)
    v1, v2 = spark.createDataFrame(V1, SCHEMA), spark.createDataFrame(V2, SCHEMA)
    assert S.upsert_or_create(v1.limit(0), path, ["order_id"], partition_by) == 0
    assert rows(S.read_latest(spark, path, v1.schema).select(columns)) == []
    assert S.upsert_or_create(v1, path, ["order_id"], partition_by) == 1
    assert rows(S.read_latest(spark, path).select(columns)) == V1
    assert S.upsert_or_create(v2, path, ["order_id"], partition_by) == 2
    assert rows(S.read_latest(spark, path).select(columns)) == sorted(V1[1:] + V2)
    assert rows(S.read_state(spark, S.committed(spark, path)[1]).select(columns)) == V1


def test_a_failed_write_leaves_the_table(spark, tmp):
    path = f"{tmp}/t"
    S.upsert_or_create(spark.createDataFrame(V1, SCHEMA), path, ["order_id"])
    broken = spark.createDataFrame([(9, "A", 1.0)], SCHEMA).withColumn("amount", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        S.upsert_or_create(broken, path, ["order_id"])
    os.makedirs(f"{path}/state=1/_temporary", exist_ok=True)  # what a killed driver leaves
    with open(f"{path}/state=1/part-0.parquet", "wb") as f:
        f.write(b"half a file")
    assert rows(S.read_latest(spark, path)) == V1
    assert S.upsert_or_create(spark.createDataFrame(V2, SCHEMA), path, ["order_id"]) == 1
    assert rows(S.read_latest(spark, path)) == sorted(V1[1:] + V2)


def test_states_are_dropped_on_request(spark, tmp):
    path = f"{tmp}/t"
    for _ in range(4):
        S.write_state(spark.createDataFrame(V1, SCHEMA), path)
    os.remove(f"{path}/state=1/_SUCCESS")
    assert list(S.committed(spark, path)) == [0, 2, 3]
    assert S.drop_states(spark, path, keep=2) == [0]
    assert list(S.committed(spark, path)) == [2, 3] and not os.path.exists(f"{path}/state=1")
    with pytest.raises(ValueError):
        S.drop_states(spark, path, keep=0)


def test_upsert_reads_each_side_once(spark, tmp):
    from tablecraft.operators.versions import upsert

    for name, data in (("old", V1), ("new", V2)):
        spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp}/{name}")
    out = upsert(spark.read.parquet(f"{tmp}/old"), spark.read.parquet(f"{tmp}/new"), ["order_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange") == 2
    assert rows(out) == sorted(V1[1:] + V2)


def test_upsert_with_other_columns(spark):
    from tablecraft.operators.versions import upsert

    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    new = spark.createDataFrame([(2, "x"), (3, "y")], "order_id int, note string")
    assert sorted(map(tuple, upsert(old, new, ["order_id"]).collect()), key=str) == [
        (1, "a", 1.0, None), (2, None, None, "x"), (3, None, None, "y")]
    assert upsert(old, new, ["order_id"]).columns == ["order_id", "status", "amount", "note"]


def test_compaction_has_no_shuffle(spark, tmp):
    from tablecraft.operators.versions import compacted

    spark.range(1000).repartition(20).write.parquet(f"{tmp}/many")
    df = compacted(spark, f"{tmp}/many")
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    df.write.parquet(f"{tmp}/few")
    assert len([f for f in os.listdir(f"{tmp}/few") if f.endswith(".parquet")]) == 1
    assert spark.read.parquet(f"{tmp}/few").agg(F.sum("id")).first()[0] == 499500
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert before != str(0) and spark.conf.get("spark.sql.files.minPartitionNum", None) is None
