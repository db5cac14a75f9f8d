"""Views, catalog listing/describe/drop, persist levels, and a small CSV ingest."""

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tablecraft.sources import catalog as C
from tablecraft.sources.readers import read_csv
from tablecraft.sources.sinks import write_bucketed

ORDERS_CSV = """order_id,customer_name,product,quantity,price,status,order_date
1,Ravi Kumar,Laptop,1,75000,COMPLETED,2024-01-10
2,Asha,Mouse,2,500,PENDING,2024-01-11
3,Mei,Phone,1,30000,COMPLETED,2024-01-11
4,Ravi Kumar,Monitor,2,15000,COMPLETED,2024-01-12
5,John,Desk,1,9000,CANCELLED,2024-01-12
6,Asha,Chair,4,5000,COMPLETED,2024-01-13
7,Mei,Tablet,1,25000,PENDING,2024-01-13
8,John,Laptop,1,75000,COMPLETED,2024-01-14
9,Ravi Kumar,Keyboard,10,2500,COMPLETED,2024-01-14
10,Asha,Lamp,1,800,SHIPPED,2024-01-15
"""


def test_csv_ingest_fixture(spark, tmp):
    path = f"{tmp}/orders.csv"
    with open(path, "w") as f:
        f.write(ORDERS_CSV)
    df = read_csv(spark, path)
    assert df.count() == 10 and df.schema["quantity"].dataType.typeName() == "integer"
    done = df.filter(F.col("status") == "COMPLETED")
    assert done.count() == 6
    total = done.agg(F.sum(F.col("quantity") * F.col("price"))).first()[0]
    assert total == 75000 + 30000 + 30000 + 20000 + 75000 + 25000
    assert df.filter(F.col("order_id").isNull() | F.col("status").isNull()).count() == 0


def test_session_and_global_views(spark):
    spark.range(5).createOrReplaceTempView("tc_view")
    spark.range(7).createOrReplaceGlobalTempView("tc_gview")
    assert spark.sql("SELECT COUNT(*) AS n FROM tc_view").first().n == 5
    assert spark.sql("SELECT COUNT(*) AS n FROM global_temp.tc_gview").first().n == 7
    assert "tc_view" in [t.name for t in spark.catalog.listTables()]
    spark.catalog.dropTempView("tc_view")
    spark.catalog.dropGlobalTempView("tc_gview")
    with pytest.raises(AnalysisException):
        spark.sql("SELECT * FROM tc_view").collect()
    with pytest.raises(AnalysisException):
        spark.sql("SELECT * FROM global_temp.tc_gview").collect()


def test_list_describe_drop(spark, tmp):
    C.create_database(spark, "tc_db", f"{tmp}/db")
    spark.range(3).write.parquet(f"{tmp}/t")
    C.register_external_parquet(spark, "tc_db", "t", "id BIGINT", f"{tmp}/t")
    assert "t" in C.list_tables(spark, "tc_db")
    assert [r.col_name for r in C.describe(spark, "tc_db.t").collect()][0] == "id"
    C.drop_table(spark, "tc_db.t")
    assert "t" not in C.list_tables(spark, "tc_db")


def test_bucketed_table_in_catalog(spark):
    name = write_bucketed(spark.range(100).withColumnRenamed("id", "k"), "tc_bucketed", 4, "k")
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert detail.get("Num Buckets") == "4" and "k" in detail.get("Bucket Columns", "")
    assert spark.table(name).count() == 100


def test_persist_levels(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    df.persist(StorageLevel.MEMORY_ONLY)
    try:
        assert df.count() == 1000 and df.storageLevel == StorageLevel.MEMORY_ONLY
        assert df.agg(F.sum("x")).first()[0] == 999 * 1000
    finally:
        df.unpersist()
    assert df.storageLevel == StorageLevel.NONE


def test_bucketed_write_one_file_per_bucket(spark, tmp):
    import os

    df = spark.range(10_000).withColumn("k", F.col("id") % 97).repartition(13)
    write_bucketed(df, "tc_files", 8, "k", path=f"{tmp}/b")
    files = [f for f in os.listdir(f"{tmp}/b") if f.endswith(".parquet")]
    assert len(files) <= 8


def test_cached_reuse_reads_the_cache(spark, sf, monkeypatch):
    from tablecraft.plans import io

    plans = []
    write = io.write_parquet
    monkeypatch.setattr(io, "write_parquet", lambda df, path: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, path))[1])
    out = io.q_cached_reuse(spark, sf)
    assert "InMemoryTableScan" in plans[0]
    assert abs(out.agg(F.sum("share")).first()[0] - 1) < 1e-9


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    import pytest

    from tablecraft.sources.scratch import scratch_root

    class Cluster:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: Cluster.conf)
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="share"):
        scratch_root(Cluster)
    Cluster.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        scratch_root(Cluster)
