"""Merge-style changes of tables kept as plain Parquet folders.

The functions are DataFrame to DataFrame; a caller that needs an earlier state keeps the
folder it was written to. Nothing here tracks versions or files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablecraft.config import MB


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched keys take the source row (update all), unmatched source rows are inserted,
    other target rows are kept. A null key matches nothing.

    Several source rows for one target row make the update ambiguous; that raises when the
    result is computed. Several source rows with a new key are all inserted.

    Both sides are read once: a full outer join, before which the source's rows are counted
    per key in the partitions that the join needs anyway. Rows with a null key, which meet
    nothing, are spread over all partitions by a hash of the row.
    """
    keys = list(keys)
    columns = target.columns + [c for c in source.columns if c not in target.columns]
    on = [f"_key{i}" for i in range(len(keys))] + ["_spread"]

    def side(df: DataFrame, mark: str) -> DataFrame:
        no_key = F.lit(False)
        for k in keys:
            no_key = no_key | F.col(k).isNull()
        row = F.struct(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])
        return df.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                         F.when(no_key, F.xxhash64(*df.columns)).otherwise(F.lit(0)).alias("_spread"), row.alias(mark))

    new = side(source, "_new").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*on)))
    both = side(target, "_old").join(new, on, "full_outer")
    ambiguous = F.raise_error(F.lit(f"several source rows match one target row on {', '.join(keys)}")).cast("boolean")
    checked = both.filter(F.when(F.col("_old").isNotNull() & (F.col("_n") > 1), ambiguous).otherwise(F.lit(True)))
    return checked.select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in columns])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove rows where ``condition`` is true; rows where it is null are kept."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def compacted(spark: SparkSession, path: str, file_bytes: int = 256 * MB) -> DataFrame:
    """The table at ``path``, in files of about ``file_bytes`` when written, without a shuffle:
    the scan packs small files into splits of that size and cuts only files above it, and a
    task writes what it reads. The frame belongs to a session of its own, as packing is a
    session setting: write it, don't combine it with others."""
    packing = spark.newSession()
    for key, value in {"maxPartitionBytes": file_bytes, "openCostInBytes": 0, "minPartitionNum": 1}.items():
        packing.conf.set(f"spark.sql.files.{key}", str(value))
    return packing.read.parquet(path)
