"""Row keys and scratch tables shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.sources.scratch import scratch_path


#: Rows and bytes of an Arrow batch. Memory of a Python worker goes by the texts it holds
#: at once, so batches of long texts must be small ones.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def small_batches(spark: SparkSession | None = None) -> None:
    """Lower the session's Arrow batch limits to ``_BATCH`` where they are higher; called by
    every operator that hands texts to Python workers."""
    spark = spark or SparkSession.getActiveSession()
    for key, most in _BATCH.items():
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or int(now) > most or int(now) <= 0:
            spark.conf.set(key, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(id_col: str, text_col: str) -> list[Column]:
    """Two 64-bit hashes that name a row by its id and whole text. Repeated rows share a
    key (they also share every result); rows that only share an id do not. Null ids and
    texts hash like any other value, so equality joins on the key need no null handling."""
    return [
        F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col)).alias("_k1"),
        F.xxhash64(F.lit(2), F.col(text_col), F.col(id_col)).alias("_k2"),
    ]


KEY = ["_k1", "_k2"]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared scratch folder and read it back: a lineage cut
    that survives lost executors and gives the planner the true size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = f"_{name}"
    while out.lower() in taken:
        out = f"_{out}"
    return out
